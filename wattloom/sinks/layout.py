"""Order over several columns at once, and reads that open only the files a range can be in.

Rows are written along a Z-order curve over two or more numeric or time columns, such as device and time, so a file holds a small box of
them. The ranges of each file stand in a small table beside the files; a read compares its bounds with that table and opens the
files that remain. Files that the table does not know, such as those of a writer that died before it, are always read.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.sinks.tables import exists

RANGES = "_ranges"
BITS = 15  # of the curve, per column
CUTS = 64  # pieces of a column's distribution, a power of two
ROWS_PER_FILE = 4_000_000
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _number(df: DataFrame, name: str) -> Column:
    """A column as a double: times as microseconds, dates as days."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(f"`{name}`").cast("timestamp")).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(f"`{name}`").cast("double")
    if not isinstance(kind, _NUMBERS):
        raise ValueError(f"{name} is {kind.simpleString()}; the order takes numbers, dates and timestamps")
    return F.col(f"`{name}`").cast("double")


def _place(value: Column, piece: Column, edges: list[float], bits: int) -> Column:
    """Place of a value as a whole number of ``bits``: its piece, and how far it is through it.

    So equal spans of places hold about as many rows, however the values are spread. NULL and NaN come first.
    """
    widths = [b - a or 1.0 for a, b in zip(edges, edges[1:], strict=False)]
    through = (value - F.get(F.lit(edges), piece)) / F.get(F.lit(widths), piece)
    at = (piece + F.greatest(F.lit(0.0), F.least(F.lit(1.0), through))) * (((1 << bits) - 1) / len(widths))
    return F.when(value.isNull() | F.isnan(value), 0).otherwise(F.floor(at)).cast("long")


def _woven(places: list[Column]) -> Column:
    """Bits of the places taken in turns, a byte of each place by a table of 256 numbers."""
    n = len(places)
    spread = [sum((byte >> b & 1) << (b * n) for b in range(8)) for byte in range(256)]
    out = F.lit(0).cast("long")
    for i, p in enumerate(places):
        for k in range(0, BITS, 8):
            byte = F.get(F.lit(spread).cast("array<bigint>"), F.shiftright(p, k).bitwiseAND(F.lit(255)).cast("int"))
            out = out.bitwiseOR(F.shiftleft(byte, k * n + n - 1 - i))
    return out


def with_curve(df: DataFrame, by: list[str], name: str = "_curve") -> tuple[DataFrame, int]:
    """``df`` with the Z-order of its rows by ``by`` in ``name``, and its number of rows, from one aggregate over the columns
    (``CUTS`` + 1 numbers each). Steps that are used more than once are columns of their own, so that no expression is computed twice."""
    if not 2 <= len(by) <= 4:
        raise ValueError("a curve runs over two to four columns")
    steps = F.lit([i / CUTS for i in range(CUTS + 1)])
    numbers = [_number(df, c) for c in by]
    finite = [F.when(~F.isnan(n), n) for n in numbers]
    known = df.agg(F.count("*").alias("n"), *(F.percentile_approx(n, steps, 1_000).alias(f"c{i}") for i, n in enumerate(finite))).first()
    edges = [known[f"c{i}"] or [] for i in range(len(by))]
    used = [i for i, e in enumerate(edges) if e and e[0] < e[-1]]
    col = lambda kind, i: F.col(f"{name}_{kind}{i}")
    out = df.withColumns({f"{name}_value{i}": numbers[i] for i in used} | {f"{name}_piece{i}": F.lit(0) for i in used}) if used else df
    step = CUTS // 2
    while step and used:
        # The last edge at or below the value, by halving: short steps, as one nested condition makes a method too long for the JVM to compile.
        out = out.withColumns({f"{name}_piece{i}": col("piece", i) + F.when(col("value", i) >= F.get(F.lit(edges[i]), col("piece", i) + step), step).otherwise(0) for i in used})
        step //= 2
    out = out.withColumns({f"{name}_place{i}": _place(col("value", i), col("piece", i), edges[i], BITS) for i in used}) if used else out
    woven = _woven([col("place", i) if i in used else F.lit(0).cast("long") for i in range(len(by))])
    return out.select(*(F.col(f"`{c}`") for c in df.columns if c != name), woven.alias(name)), known["n"]


def write_curved(df: DataFrame, path: str, by: list[str], rows_per_file: int = ROWS_PER_FILE, mode: str = "overwrite") -> None:
    """Parquet files of about ``rows_per_file`` rows along the curve over ``by``, and their ranges.

    ``df`` is read twice, for the cuts and for the rows; it should be a table. Cuts are approximate and decide only which rows share a file. A place
    of the curve that many rows share, such as a device of which a third of all rows are, is cut further by the columns themselves and a hash
    of the row, so no task holds it whole.
    """
    name = "_curve"
    while any(c.startswith(name) for c in df.columns):
        name = "_" + name
    rows, n = with_curve(df, by, name)
    keys = [name, *(f"`{c}`" for c in reversed(by))]
    plain = [f"`{f.name}`" for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    placed = rows.repartitionByRange(max(1, -(-n // rows_per_file)), *keys, F.xxhash64(*plain)).sortWithinPartitions(*keys)
    placed.drop(name).write.mode(mode).parquet(path)
    write_ranges(df.sparkSession, path, by)


def write_ranges(spark: SparkSession, path: str, by: list[str]) -> None:
    """Least and greatest value of ``by`` in each file; reads these columns only. Files of a later append are unknown until this is run again."""
    rows = spark.read.parquet(path)
    bounds = [x for c in by for x in (F.min(f"`{c}`").alias(f"{c}_min"), F.max(f"`{c}`").alias(f"{c}_max"))]
    named = rows.select("*", F.col("_metadata.file_path").alias("_file"))
    named.groupBy("_file").agg(F.count("*").alias("_rows"), *bounds).coalesce(1).write.mode("overwrite").parquet(f"{path}/{RANGES}")


def files_in(spark: SparkSession, path: str, bounds: dict[str, tuple]) -> tuple[list[str], list[str]]:
    """Files that can hold rows within ``bounds`` (column to lowest and highest value, both included, None for no bound), and all files.

    The driver sees a list of the table's files, as it does for any read of it.
    """
    every = spark.read.parquet(path).inputFiles()
    if not exists(spark, f"{path}/{RANGES}"):
        return every, every
    known = spark.read.parquet(f"{path}/{RANGES}")
    out = F.lit(False)
    for name, (low, high) in bounds.items():
        if f"{name}_min" not in known.columns:
            continue
        # A file without a value in a column holds no row within its bounds.
        out = out | F.col(f"`{name}_min`").isNull()
        if low is not None:
            out = out | (F.col(f"`{name}_max`") < F.lit(low).cast(known.schema[f"{name}_max"].dataType))
        if high is not None:
            out = out | (F.col(f"`{name}_min`") > F.lit(high).cast(known.schema[f"{name}_min"].dataType))
    outside = {_plain(r["_file"]) for r in known.filter(out).select("_file").collect()}
    return [f for f in every if _plain(f) not in outside], every


def _plain(file: str) -> str:
    """One spelling of a file's address: listings and rows differ in escapes and slashes."""
    scheme, _, rest = unquote(file).partition(":")
    return f"{scheme}:/{rest.lstrip('/')}" if scheme == "file" else unquote(file)


def read_curved(spark: SparkSession, path: str, bounds: dict[str, tuple]) -> DataFrame:
    """Rows of a folder of :func:`write_curved` within ``bounds``, from the files that can hold them; a NULL is within no bound."""
    whole = spark.read.parquet(path)
    files, every = files_in(spark, path, bounds)
    opened = spark.read.schema(whole.schema).option("basePath", path)
    rows = whole.limit(0) if every and not files else opened.parquet(*(map(unquote, files) if files else [path]))
    for name, (low, high) in bounds.items():
        kind, column = whole.schema[name].dataType, F.col(f"`{name}`")
        rows = rows.filter(column.isNotNull())
        rows = rows if low is None else rows.filter(column >= F.lit(low).cast(kind))
        rows = rows if high is None else rows.filter(column <= F.lit(high).cast(kind))
    return rows
