"""Ranked lexical search over a length-stratified index.

The index is cut by documents: a shard holds all postings of some thousand documents, so a term that stands in every document is no
longer list in any task than a rare one, and no posting is shuffled. Only counts cross shards: documents, terms, and in how many
documents the terms asked for stand.

In a shard documents are grouped by equal length normaliser m (a stratum); the postings of a term are ordered by stratum, then by
falling tf. A term's impact on a document depends on tf and m alone, so it is worked out once per run of equal tf, and
the first run of a term in a stratum bounds all its others. For each item the strata are visited by falling bound, some at a time, until the
bound is below the k-th best score found so far by the task; then no document left can enter the list. Items are read in blocks of
bounded bytes; all shards are read once per block.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.base import query, stored, table
from wattloom.llm.blocks import blocks
from wattloom.llm.shingles import text_groups

SHARD = 1 << 20  # postings of a shard, reached by whole groups of documents
ITEM_BYTES = 8 << 20  # of a block of items
FIRST = 8  # strata visited at first; four times as many each time after
NORM = 75  # per cent of the normaliser that follow the document's length
_ONE = 1_000_000_000
_KEEP = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TABLE = bytes((b + 32 if 0x41 <= b < 0x5B else b) if b in _KEEP else 0x20 for b in range(256))
SHARDS = "n_docs long, n_terms long, ids array<long>, lengths array<int>, terms array<binary>, starts array<int>, docs binary, tfs binary"


def terms_of(text: str | None) -> list[bytes]:
    """Letters and digits of ASCII and all else beyond it, in runs; only A-Z are lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


class Shard:
    """Postings of documents while they come in."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.postings = 0

    def add(self, ids: list, texts: list) -> None:
        found = [(i, t) for i, t in zip(ids, map(terms_of, texts), strict=True) if t]
        if not found:
            return
        sizes = [len(t) for _, t in found]
        told = pa.array([x for _, t in found for x in t], pa.binary()).dictionary_encode()
        numbers = np.array([self.numbers.setdefault(x, len(self.numbers)) for x in told.dictionary.to_pylist()], np.int64)
        doc = np.repeat(np.arange(len(found)), sizes)
        code, tf = np.unique(doc * len(numbers) + told.indices.to_numpy(), return_counts=True)
        self.parts.append((numbers[code % len(numbers)], code // len(numbers) + len(self.ids), tf))
        self.ids += [i for i, _ in found]
        self.lengths += sizes
        self.postings += len(code)

    def row(self) -> pa.RecordBatch:
        """Documents by length, terms by their bytes, postings by term and document."""
        by_length = np.argsort(np.array(self.lengths), kind="stable")
        names = sorted(self.numbers)
        place = np.empty(len(names), np.int64)
        place[[self.numbers[x] for x in names]] = np.arange(len(names))
        rank = np.empty(len(by_length), np.int64)
        rank[by_length] = np.arange(len(by_length))
        term, doc, tf = (np.concatenate([p[k] for p in self.parts]) for k in range(3))
        term, doc = place[term], rank[doc]
        order = np.argsort(term * len(rank) + doc, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(names)))])
        lengths = np.array(self.lengths)[by_length]
        return pa.RecordBatch.from_arrays([
            pa.array([len(rank)], pa.int64()), pa.array([int(lengths.sum())], pa.int64()),
            pa.array([[self.ids[i] for i in by_length]], pa.list_(pa.int64())), pa.array([lengths.tolist()], pa.list_(pa.int32())),
            pa.array([names], pa.list_(pa.binary())), pa.array([starts.tolist()], pa.list_(pa.int32())),
            pa.array([doc[order].astype(np.int32).tobytes()], pa.binary()), pa.array([tf[order].astype(np.int32).tobytes()], pa.binary()),
        ], ["n_docs", "n_terms", "ids", "lengths", "terms", "starts", "docs", "tfs"])


def index(docs: DataFrame, size: int = SHARD) -> DataFrame:
    """Shards of all rows of ``docs`` (``doc_id``, ``text``) that have a term, stored."""
    def build(batches):
        shard = Shard()
        for (ids,), texts in text_groups(batches):
            shard.add(ids.to_pylist(), texts)
            if shard.postings >= size:
                yield shard.row()
                shard = Shard()
        if shard.ids:
            yield shard.row()

    return stored(docs.select("text", F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(build, SHARDS), "shards")


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of many ranges, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class Strata:
    """The part of a shard that belongs to the terms asked for, by term, stratum and falling tf."""

    def __init__(self, ids, lengths, starts, docs, tfs, at: np.ndarray, n: int, total: int) -> None:
        """``at``: number of each term asked for in the shard, -1 where it is not there."""
        self.ids = ids
        length, per_doc = np.unique(lengths, return_inverse=True)
        m_of = np.array([100 - NORM + NORM * int(x) * n // total for x in length], np.int64)  # rises with the length
        self.m, stratum = np.unique(m_of, return_inverse=True)
        stratum = stratum[per_doc]
        there = np.flatnonzero(at >= 0)
        begin, size = starts[at[there]], starts[at[there] + 1] - starts[at[there]]
        pos = ranges(begin, size)
        term, doc, tf = np.repeat(there, size), docs[pos].astype(np.int64), tfs[pos].astype(np.int64)
        most = int(tf.max(initial=0)) + 1
        key = (term * len(self.m) + stratum[doc]) * most + (most - 1 - tf)
        order = np.argsort(key, kind="stable")
        key, self.doc = key[order], doc[order]
        run = np.flatnonzero(np.diff(key, prepend=-1))  # equal term, stratum and tf
        run_tf, cell = most - 1 - key[run] % most, key[run] // most
        impact = (_ONE * run_tf) // (1000 * run_tf + 8 * self.m[cell % len(self.m)])
        self.impact = np.repeat(impact, np.diff(np.append(run, len(key))))
        first = np.flatnonzero(np.diff(cell, prepend=-1))  # a term's first run in a stratum
        self.group_term, self.group_stratum = cell[first] // len(self.m), cell[first] % len(self.m)
        self.bound, self.group_at = impact[first], run[first]
        self.group_size = np.diff(np.append(self.group_at, len(key)))
        self.term_at = np.searchsorted(self.group_term, np.arange(len(at) + 1))
        self.score = np.zeros(len(ids), np.int64)

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, held: list) -> list:
        """``held`` (best first: ``(-score, id is NULL, id)``) with the documents that belong among its first ``k``."""
        size = self.term_at[terms + 1] - self.term_at[terms]
        groups, weight = ranges(self.term_at[terms], size), np.repeat(weights, size)
        bounds = np.zeros(len(self.m), np.int64)
        np.add.at(bounds, self.group_stratum[groups], weight * self.bound[groups])
        order = np.argsort(-bounds, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        at = place[self.group_stratum[groups]]
        a, step = 0, FIRST
        while a < len(order):
            least = -held[k - 1][0] if len(held) >= k else 1
            b = min(a + step, len(order), int(np.searchsorted(-bounds[order], -least, side="right")))
            if b <= a:
                break
            now = (at >= a) & (at < b)
            g, w = groups[now], weight[now]
            pos = ranges(self.group_at[g], self.group_size[g])
            np.add.at(self.score, self.doc[pos], np.repeat(w, self.group_size[g]) * self.impact[pos])
            found = np.flatnonzero(self.score)
            score = self.score[found]
            self.score[found] = 0
            if len(found) > k:
                least = max(least, int(np.partition(score, len(score) - k)[len(score) - k]))
            enter = score >= least
            new = [(-s, self.ids[d] is None, self.ids[d] or 0) for s, d in zip(score[enter].tolist(), found[enter].tolist(), strict=True)]
            held = sorted(held + new)[:k] if new else held
            a, step = b, step * 4
        return held


def counts(shards: DataFrame, vocabulary: list[bytes]) -> dict[bytes, int]:
    """In how many documents each term stands; the vocabulary of a block of items."""
    asked = pa.array(vocabulary, pa.binary())

    def count(batches):
        for batch in batches:
            for terms, starts in zip(batch.column(0), batch.column(1), strict=True):
                at = pc.index_in(asked, value_set=terms.values)
                sizes = np.diff(starts.values.to_numpy())
                there = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([asked.take(pa.array(there)), pa.array(sizes[at.fill_null(0).to_numpy()[there]], pa.int64())], ["term", "df"])

    found = shards.select("terms", "starts").mapInArrow(count, "term binary, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {bytes(r.term): r.df for r in found.collect()}


def search(shards: DataFrame, items: DataFrame, k: int = 10, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the ``k`` best documents of every row of ``items`` (``item_id``, ``text``).

    A term's weight is ``floor(1000 * ln((2N + 2) / (2df + 1)))``, its impact ``10^9 tf div (1000 tf + 8 m)``; the score adds weight times
    impact over the item's terms with repeats. Scores above 0 only; equal ones by ascending ``doc_id``, NULL last. Rows that repeat are
    documents, and items, each. NULL texts and texts without terms find nothing and are not found; empty tables give no rows.
    """
    rows = stored(items.select(F.col("item_id").cast("long").alias("item_id"), "text").withColumn("row", F.monotonically_increasing_id()), "items")
    n, total = shards.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    out = None
    for held in blocks(rows, F.coalesce(F.octet_length("text"), F.lit(0)), item_bytes) if n else []:
        found = visit(shards, [(r.row, r.item_id, Counter(terms_of(r.text))) for r in held], n, total, k)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return rows.filter("false").select("item_id", F.lit(0).alias("rank"), F.col("row").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    by = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return out.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def visit(shards: DataFrame, items: list[tuple[int, int | None, Counter]], n: int, total: int, k: int) -> DataFrame:
    """The ``k`` best documents of each item in each task."""
    vocabulary = sorted({t for _, _, terms in items for t in terms})
    df = counts(shards, vocabulary)
    number = {t: i for i, t in enumerate(vocabulary)}
    weigh = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in df}
    asked = []
    for row, item_id, terms in items:
        known = sorted(t for t in terms if weigh.get(t, 0) > 0)
        asked.append((row, item_id, np.array([number[t] for t in known], np.int64), np.array([terms[t] * weigh[t] for t in known], np.int64)))
    names = pa.array(vocabulary, pa.binary())

    def read(batches):
        best: list[list] = [[] for _ in asked]
        for batch in batches:
            for _, _, ids, lengths, terms, starts, docs, tfs in zip(*(batch.column(i) for i in range(8)), strict=True):
                at = pc.index_in(names, value_set=terms.values).fill_null(-1).to_numpy().astype(np.int64)
                strata = Strata(
                    ids.as_py(), lengths.values.to_numpy(), starts.values.to_numpy().astype(np.int64),
                    np.frombuffer(docs.as_buffer(), np.int32), np.frombuffer(tfs.as_buffer(), np.int32), at, n, total,
                )
                for i, (_, _, known, weights) in enumerate(asked):
                    best[i] = strata.best(known, weights, k, best[i])
        out = [(asked[i][0], asked[i][1], None if none else d, -s) for i, found in enumerate(best) for s, none, d in found]
        cols = list(zip(*out, strict=True)) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["row", "item_id", "doc_id", "score"])

    return shards.mapInArrow(read, "row long, item_id long, doc_id long, score long")


SQL = r"""
WITH lists AS (SELECT doc_id, row_number() OVER () AS d, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
sizes AS (SELECT doc_id, d, CAST(len(ts) AS BIGINT) AS n FROM lists WHERE len(ts) > 0),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
norms AS (SELECT doc_id, d, 100 - 75 + (75 * n * docs) // total AS m FROM sizes, whole),
postings AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(ts) AS term FROM lists) GROUP BY d, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), whole),
asked AS (
  SELECT r, item_id, term, count(*) AS c FROM (
    SELECT row_number() OVER () AS r, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM benchmark),
    unnest(ts) AS u(term) GROUP BY r, item_id, term),
scored AS (
  SELECT r, item_id, doc_id, d, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN norms USING (d) GROUP BY r, item_id, doc_id, d),
ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10"""


@query("op11_ranked_lexical_search", SQL)
def op11(spark, folder):
    return search(index(table(spark, folder, "documents")), table(spark, folder, "benchmark"))
