"""Climate files as a data source: ``spark.read.format("clm")``, split by station and byte range.

``spark.dataSource.register(ClmSource)`` first, or call :func:`read_clm_ranges`. Addresses are paths or those that Arrow's file systems know; a
folder is all climate files below it.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from wattloom.sources.climate import HEADER_LINES, LINES_PER_DAY, SITE_LINE

SCHEMA = "station STRING, date DATE, hour INT, solar_intensity DOUBLE, temp DOUBLE, torn STRING"
RANGE_BYTES = 32 << 20
PEEK = 4096  # bytes read at a time while looking for a line
ROWS = 8192  # of one batch
# Fixed value: the line that begins a day.
DAY = re.compile(rb"\*\s*day\s+(\d+)\s+month\s+(\d+)\s*$")
_ARROW = pa.schema([("station", pa.string()), ("date", pa.date32()), ("hour", pa.int32()), ("solar_intensity", pa.float64()), ("temp", pa.float64()), ("torn", pa.string())])


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int
    size: int


class ClmSource(DataSource):
    """Options: ``year`` in place of that of the site line; ``rangeBytes``, bytes of a file per task.

    Rows are hours as ``parse_clm`` gives them, and ``torn`` lines: an hour line without six numbers in its first three fields and six fields, a day line
    that names no day, or a line beyond the 24 hours of its day. Torn rows have their text, and the date and hour where these are known; other rows have NULL there.
    Blank lines are no rows.
    """

    @classmethod
    def name(cls) -> str:
        return "clm"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ClmReader:
        return ClmReader(self.options)


class ClmReader(DataSourceReader):
    """Days of a file ascend, as the format has them, so a range is passed over when its first day is behind the wanted dates, or that of the next
    range is not past the first wanted one; either takes a look of a few KB. Days that do not ascend inside a range are an error."""

    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.year = int(options["year"]) if options.get("year") else None
        self.bytes = int(options.get("rangebytes") or options.get("rangeBytes") or RANGE_BYTES)
        self.low, self.high = dt.date.min, dt.date.max

    def pushFilters(self, filters: list) -> Iterator:
        """Narrows the dates; every filter is given back, as ranges are cut at days of whole ranges only."""
        for f in filters:
            value = getattr(f, "value", None)
            if getattr(f, "attribute", None) == ("date",) and value is not None:
                if isinstance(f, In):
                    days = [v for v in value if v is not None]
                    if days:
                        self.low, self.high = max(self.low, min(days)), min(self.high, max(days))
                elif isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.low = max(self.low, value)
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    self.high = min(self.high, value)
            yield f

    def partitions(self) -> list[Range]:
        """Ranges of the listed files; no file is opened here."""
        out = []
        for path in self.path.split(","):
            system, inside = open_system(path)
            info = system.get_file_info(inside)
            if info.type == fs.FileType.NotFound:
                raise FileNotFoundError(path)
            files = [info] if info.is_file else system.get_file_info(fs.FileSelector(inside, recursive=True))
            for f in files:
                if f.is_file and not f.base_name.startswith(("_", ".")):
                    address = path if info.is_file else path.rstrip("/") + f.path[len(inside.rstrip("/")):]
                    out += [Range(address, s, min(s + self.bytes, f.size), f.size) for s in range(0, f.size, self.bytes)]
        return out

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        system, inside = open_system(part.path)
        with system.open_input_file(inside) as file:
            body, year = header(file)
            year = self.year if self.year is not None else year
            start, first = day_line(file, max(part.start, body), part.end)
            if first is None and part.start > body:
                return  # no day begins here: the range before reads on to the next one
            end, after = day_line(file, max(part.end, body), part.size) if part.end < part.size else (part.size, None)
            # A range that reaches the header begins behind it, whatever its first line is.
            start = body if part.start <= body else start
            if self.passed(year, first, after):
                return
            yield from batches(part.path, year, lines(file, start, end))

    def passed(self, year: int | None, first: tuple | None, after: tuple | None) -> bool:
        """Whether no day from ``first`` until before ``after`` is wanted. Days that are no dates leave it open."""
        begin, stop = date_of(year, first), date_of(year, after)
        return (begin is not None and begin > self.high) or (stop is not None and stop <= self.low)


def open_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if re.match(r"[a-z][a-z0-9+.-]+:", path) else (fs.LocalFileSystem(), path)


def header(file: pa.NativeFile) -> tuple[int, int | None]:
    """Where the header ends, and the year that it names."""
    text, size = b"", file.size()
    while text.count(b"\n") < HEADER_LINES and len(text) < size:
        text += file.read_at(min(PEEK, size - len(text)), len(text))
    rows = text.split(b"\n", HEADER_LINES)
    body = size if len(rows) <= HEADER_LINES else len(text) - len(rows[-1])
    named = re.match(rb"\s*(\d+)\s*(?:,|$)", rows[SITE_LINE].split(b",")[0]) if len(rows) > SITE_LINE else None
    return body, int(named[1]) if named else None


def day_line(file: pa.NativeFile, start: int, end: int) -> tuple[int, tuple[int, int] | None]:
    """Where the first day line that begins in ``start`` … ``end`` begins, and its month and day; the file's end without one. A line begins
    behind a line feed; one that begins at ``start`` itself counts."""
    size = file.size()
    at, begins = max(0, start - 1), start == 0
    rest = b""
    while at < size and at - len(rest) < end:
        got = file.read_at(min(PEEK, size - at), at)
        rest, base = rest + got, at - len(rest)
        at += len(got)
        if not begins:
            cut = rest.find(b"\n")
            if cut < 0:
                rest = b""
                continue
            rest, base, begins = rest[cut + 1 :], base + cut + 1, True
        rows = rest.split(b"\n")
        whole = rows if at >= size else rows[:-1]
        for row in whole:
            if base >= end:
                return size, None
            if day := DAY.match(row.rstrip(b"\r")):
                return base, (int(day[2]), int(day[1]))
            base += len(row) + 1
        rest = b"" if at >= size else rows[-1]
    return size, None


def lines(file: pa.NativeFile, start: int, end: int) -> Iterator[bytes]:
    """Lines from ``start`` until ``end``, where a line begins or the file ends."""
    rest, at = b"", start
    while at < end:
        got = file.read_at(min(1 << 20, end - at), at)
        at += len(got)
        *rows, rest = (rest + got).split(b"\n")
        yield from rows
    if rest:
        yield rest


def date_of(year: int | None, day: tuple[int, int] | None) -> dt.date | None:
    try:
        return dt.date(year, *day) if day and year else None
    except ValueError:
        return None


def number(text: bytes) -> float | None:
    try:
        return float(text)
    except ValueError:
        return None


def batches(station: str, year: int | None, rows: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    day, hour, last = None, LINES_PER_DAY, None
    for row in rows:
        row = row.rstrip(b"\r")
        if not row.strip():
            continue
        if found := DAY.match(row):
            key = (int(found[2]), int(found[1]))
            if last is not None and key < last:
                raise ValueError(f"{station}: day {key[1]} of month {key[0]} comes behind a later one")
            last, day, hour = key, date_of(year, key), 0
            continue
        broken = row.lstrip().startswith(b"*")
        hour += not broken
        fields = row.split(b",")
        values = [number(f) for f in fields[:3]]
        known = hour if hour < LINES_PER_DAY and not broken else None
        if known is None or len(fields) != 6:
            out.append((station, day, known, None, None, row.decode("utf-8", "replace")))
        else:
            text = row.decode("utf-8", "replace") if None in values else None
            out.append((station, day, hour, values[2], None if values[1] is None else values[1] / 10, text))
        if len(out) >= ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _ARROW, strict=True)], schema=_ARROW)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _ARROW, strict=True)], schema=_ARROW)


def read_clm_ranges(spark: SparkSession, path: str | list[str], year: int | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Hours and torn lines of climate files by :class:`ClmSource`; filters on ``date`` reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ClmSource)
    reader = spark.read.format("clm").option("rangeBytes", range_bytes)
    reader = reader if year is None else reader.option("year", year)
    return reader.load(path if isinstance(path, str) else ",".join(path))
