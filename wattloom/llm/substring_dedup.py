"""Repeated passages: sentences, lines and paragraphs keep their earliest occurrence, longer runs of repeated ones are removed.

Units tile a text: a line ends behind its line feed; inside a line a sentence ends behind the white space after ``. ! ? …`` or
behind ``。！？``. A repeated line or paragraph is a run of repeated sentences, so one grain serves all three. Two units are
the same when they are equal after A-Z are lower-cased and white space is joined; units without other characters count
for nothing. Occurrences are ranked by document id (NULL last), then row, then place; each digest keeps its
earliest one, whatever becomes of that. The others are repeated, and a run of consecutive repeated units goes
when it has ``MIN_CHARS`` characters at least, joined white space included: short formulas that stand in many texts stay. Characters and
not words are counted, so scripts without spaces are treated alike.

A task keeps the earliest occurrence it has seen of each digest, so a line that stands everywhere sends one row per batch to the
shuffle; the earliest of these wins. Offsets are those of the original text, in code points, and stay with the document when its text is cut.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.base import query, stored, table

MIN_CHARS = 200
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
_END = re.compile(r"[.!?…]+[\x20\x09\x0B-\x0D]+|[。！？]+[\x20\x09\x0B-\x0D]*|\n")
SPANS = "array<struct<start:int,end:int>>"


def units(text: str) -> list[int]:
    """Ends of the units; each begins where the one before ends."""
    ends = [m.end() for m in _END.finditer(text)]
    if (ends[-1] if ends else 0) < len(text):
        ends.append(len(text))
    return ends


def normal(unit: str) -> str:
    return _SPACE.sub(" ", unit.translate(_LOWER)).strip(" ")


def runs(ends: list[int], sizes: list[int], late, min_chars: int) -> tuple[list[tuple[int, int]], int]:
    """Spans to remove, and how many units they hold. ``late``: numbers of the repeated units; ``sizes``: 0 for units that don't count."""
    spans, removed = [], 0
    late = set(late)
    first = last = -1
    total = count = 0
    for k in [*(k for k, s in enumerate(sizes) if s), -1]:
        if k in late:
            first = k if first < 0 else first
            last, total, count = k, total + sizes[k], count + 1
        else:
            if total >= min_chars:
                spans.append((ends[first - 1] if first else 0, ends[last]))
                removed += count
            first, total, count = -1, 0, 0
    return spans, removed


def scan(docs: DataFrame) -> DataFrame:
    """Stored rows of documents (``row``, ``doc_id``, ``digest`` NULL, unit ``ends`` and ``sizes``, units repeated within the
    batch in ``late``) and of earliest occurrences in a batch (``digest``, ``unit``)."""
    def read(batches):
        for batch in batches:
            rows, ids, texts = (batch.column(i).to_pylist() for i in range(3))
            order = sorted(range(len(rows)), key=lambda i: (ids[i] is None, ids[i] or 0, rows[i]))
            seen: set[bytes] = set()
            own: tuple[list, ...] = ([], [], [], [])
            whole: tuple[list, ...] = ([], [], [], [], [])
            for i in order:
                t = texts[i] or ""
                ends, sizes, late, at = units(t), [], [], 0
                for k, e in enumerate(ends):
                    unit = normal(t[at:e])
                    at = e
                    sizes.append(len(unit))
                    if not unit:
                        continue
                    digest = xxhash.xxh3_128_digest(unit.encode("utf-8", "surrogatepass"))
                    if digest in seen:
                        late.append(k)
                    else:
                        seen.add(digest)
                        for col, v in zip(own, (rows[i], ids[i], digest, k), strict=True):
                            col.append(v)
                for col, v in zip(whole, (rows[i], ids[i], ends, sizes, late), strict=True):
                    col.append(v)
            lists = pa.list_(pa.int32())
            n, m = len(own[0]), len(whole[0])
            yield pa.RecordBatch.from_arrays([
                pa.array(own[0] + whole[0], pa.int64()), pa.array(own[1] + whole[1], pa.int64()),
                pa.array(own[2] + [None] * m, pa.binary()), pa.array(own[3] + [None] * m, pa.int32()),
                *(pa.array([None] * n + c, lists) for c in whole[2:]),
            ], ["row", "doc_id", "digest", "unit", "ends", "sizes", "late"])

    lists = "ends array<int>, sizes array<int>, late array<int>"
    return stored(docs.select("row", "doc_id", "text").mapInArrow(read, f"row long, doc_id long, digest binary, unit int, {lists}"), "units")


def removed(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``row``, ``doc_id``, ``n_units``, ``n_removed`` (units) and ``spans`` to remove of every row of ``docs`` (``row``, ``doc_id``, ``text``)."""
    made = scan(docs)
    own = made.filter("digest IS NOT NULL").select("row", "doc_id", "digest", "unit")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "unit")
    first = own.groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("times"))
    repeated = stored(first.filter("times > 1").select(F.col("digest").alias("same"), F.col("first.row").alias("row1"), F.col("first.unit").alias("unit1")), "repeated")
    hit = own.join(repeated, F.col("digest") == F.col("same"))
    later = hit.filter((F.col("row") != F.col("row1")) | (F.col("unit") != F.col("unit1"))).groupBy(F.col("row").alias("in_row")).agg(F.collect_list("unit").alias("more"))
    rows = made.filter("digest IS NULL").select("row", "doc_id", "ends", "sizes", "late")
    rows = rows.join(later, rows.row == later.in_row, "left").withColumn("late", F.concat("late", F.coalesce("more", F.array().cast("array<int>"))))

    @F.pandas_udf(f"n_units long, n_removed long, spans {SPANS}")
    def cut(ends: pd.Series, sizes: pd.Series, late: pd.Series) -> pd.DataFrame:
        out = []
        for e, s, gone in zip(ends, sizes, late, strict=True):
            spans, n = runs(e.tolist(), s.tolist(), gone.tolist(), min_chars) if len(gone) else ([], 0)
            out.append((int(np.count_nonzero(s)), n, [{"start": a, "end": b} for a, b in spans]))
        return pd.DataFrame(out, columns=["n_units", "n_removed", "spans"])

    return rows.select("row", "doc_id", cut("ends", "sizes", "late").alias("found")).select("row", "doc_id", "found.*")


def deduplicated(docs: DataFrame, min_chars: int = MIN_CHARS, spans: str = "removed") -> DataFrame:
    """All rows and columns of ``docs``; ``text`` without removed passages, and their original offsets in a new column ``spans``, whose
    name must be free. A NULL text stays NULL."""
    if spans in docs.columns:
        raise ValueError(f"{spans} is a column of the documents: name another for the spans")
    kept = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    found = removed(kept.select(F.col("__row").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"), min_chars)

    @F.pandas_udf("string")
    def cut(text: pd.Series, gone: pd.Series) -> pd.Series:
        out = []
        for t, parts in zip(text, gone, strict=True):
            if t is not None and len(parts):
                at = [0, *(g["end"] for g in parts)]
                t = "".join(t[a:b] for a, b in zip(at, [*(g["start"] for g in parts), len(t)], strict=True))
            out.append(t)
        return pd.Series(out, dtype=object)

    told = stored(found.select(F.col("row").alias("__row"), F.col("spans").alias("__spans")), "removed")
    joined = kept.join(told, "__row")
    return joined.select(*[cut("text", "__spans").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns], F.col("__spans").alias(spans))


def report(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id``, ``n_units``, ``n_removed`` (units), ``chars_removed``, ``removed`` (``start:end`` of each passage by place) of every row.

    NULL and empty texts have no units. Of rows that repeat, the first in the table keeps its units. An empty table gives no rows.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = removed(rows, min_chars)
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    listed = F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))))
    return found.select("doc_id", "n_units", "n_removed", size.alias("chars_removed"), listed.alias("removed"))


SQL = r"""
WITH tiles AS (
  SELECT doc_id, regexp_extract_all(text, '[^\n]*?(?:[.!?…]+[\x20\x09\x0B-\x0D]+|[。！？]+[\x20\x09\x0B-\x0D]*|\n|$)') AS parts FROM documents),
cut AS (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS k FROM tiles),
placed AS (
  SELECT doc_id, k, sum(length(part)) OVER (PARTITION BY doc_id ORDER BY k) AS stop, length(part) AS size,
    trim(regexp_replace(translate(part, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm
  FROM cut),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY norm ORDER BY doc_id, k) > 1 AS late, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS place
  FROM placed WHERE norm <> ''),
islands AS (SELECT *, place - row_number() OVER (PARTITION BY doc_id, late ORDER BY k) AS island FROM ranked),
gone AS (
  SELECT doc_id, min(stop - size) AS a, max(stop) AS b, count(*) AS n FROM islands WHERE late
  GROUP BY doc_id, island HAVING sum(length(norm)) >= 200),
per AS (SELECT doc_id, sum(n) AS n, sum(b - a) AS chars, string_agg(CAST(a AS BIGINT) || ':' || CAST(b AS BIGINT), ',' ORDER BY a) AS spans FROM gone GROUP BY doc_id),
counted AS (SELECT doc_id, count(*) AS n FROM ranked GROUP BY doc_id)
SELECT d.doc_id, coalesce(c.n, 0) AS n_units, CAST(coalesce(p.n, 0) AS BIGINT) AS n_removed, CAST(coalesce(p.chars, 0) AS BIGINT) AS chars_removed, coalesce(p.spans, '') AS removed
FROM documents d LEFT JOIN per p ON p.doc_id = d.doc_id LEFT JOIN counted c ON c.doc_id = d.doc_id"""


@query("op8_substring_dedup", SQL)
def op8(spark, folder):
    return report(table(spark, folder, "documents"))
