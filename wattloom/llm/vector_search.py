"""Exact top-k search by inner product: columnar branch and bound.

Vectors are rounded down to integers and packed into chunks in vertical layout, one line of a chunk holds one component of all its
vectors. Components are accumulated block by block, those where the queries have most mass first. After each block a
candidate's score is at most its partial sum plus the product of both remaining lengths (Cauchy-Schwarz); candidates
that can't reach the query's k-th best score any more are compacted away. At first all candidates of a chunk are
held for all queries of a tile, as products of matrices; once few pairs survive, only these pairs go on.

The query set is read in blocks of bounded bytes; every block meets all chunks, which are dealt out to tasks, and a task puts out
its k best of each query. No pair of vectors is written, and no task holds more than a block, a tile and a chunk.

Sums are exact: below 2^53 in doubles, else in whole numbers of any size, without bounds (a score beyond 64 bits is given as the
nearest 64-bit number, its rank follows the true one).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.base import query, stored, table
from wattloom.llm.blocks import blocks

SCALE = 256
CHUNK, CELLS = 4096, 1 << 20  # vectors, and components at most, of a chunk
TILE = 256  # queries that meet a chunk together
STEP = 16  # components of a block
FEW = 8  # pairs go on one by one when at most one in so many survives
QUERY_BYTES = 16 << 20  # of a block of queries
CHUNKS = 4  # of a task
EXACT, LONG = 2.0**53, 2**63 - 1


def chunked(vectors: DataFrame, scale: int = SCALE, where: Column | None = None) -> DataFrame:
    """``w``, ``n``, ``row``, ``id`` (NULL where the id is), ``ints`` (whole numbers, line by line) of chunks of vectors of equal width.

    ``vectors`` has ``row`` (unique), ``vec_id``, ``embedding``. NULL vectors and those that hold NULL or non-finite components are left out.
    """
    rows = vectors if where is None else vectors.filter(where)
    good = F.col("embedding").isNotNull() & F.forall("embedding", lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) < float("inf")))
    rows = rows.filter(good).select("row", F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))

    def pack(batches):
        held: dict[int, list] = {}

        def chunk(w: int) -> pa.RecordBatch:
            parts = held.pop(w)
            whole = np.concatenate([p[2] for p in parts])
            if whole.dtype != object and len(whole):  # big enough for the largest number, no bigger
                most = max(abs(int(whole.min(initial=0))), abs(int(whole.max(initial=0))))
                whole = whole.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64)
            kind = str(whole.dtype) if whole.dtype != object else "object"
            raw = np.ascontiguousarray(whole.T).tobytes() if kind != "object" else ",".join(map(str, whole.T.ravel())).encode()
            ids = [x for p in parts for x in p[1]]
            return pa.RecordBatch.from_arrays([
                pa.array([w], pa.int32()), pa.array([len(ids)], pa.int32()), pa.array([[x for p in parts for x in p[0]]], pa.list_(pa.int64())),
                pa.array([ids], pa.list_(pa.int64())), pa.array([kind]), pa.array([raw], pa.binary()),
            ], ["w", "n", "row", "id", "kind", "ints"])

        for batch in batches:
            lists = batch.column(2)
            flat, sizes = lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())
            starts = np.cumsum(sizes) - sizes
            row, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for w in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == w)
                x = flat[(starts[at][:, None] + np.arange(w)[None, :])] if w else np.empty((len(at), 0))
                x = np.floor(x * scale)
                if x.size and np.abs(x).max() >= 2.0**62:
                    x = np.array([[_floor(v, scale) for v in r] for r in flat[(starts[at][:, None] + np.arange(w)[None, :])]], object)
                else:
                    x = x.astype(np.int64)
                most = max(1, min(CHUNK, CELLS // max(w, 1)))
                for a in range(0, len(at), most):
                    held.setdefault(w, []).append(([row[i] for i in at[a : a + most]], [ids[i] for i in at[a : a + most]], x[a : a + most]))
                    if sum(len(p[0]) for p in held[w]) >= most:
                        yield chunk(w)
        for w in list(held):
            yield chunk(w)

    return rows.mapInArrow(pack, "w int, n int, row array<long>, id array<long>, kind string, ints binary")


def _floor(v: float, scale: int) -> int:
    n, d = float(v).as_integer_ratio()
    return n * scale // d


def numbers(kind: str, ints: bytes, w: int, n: int) -> np.ndarray:
    """Components of a chunk, ``w`` lines of ``n``."""
    if kind == "object":
        return np.array([int(x) for x in ints.split(b",")], object).reshape(w, n)
    return np.frombuffer(ints, kind).reshape(w, n)


def beyond(score: int) -> bytes | None:
    """Bytes in the order of the numbers, for scores that a long can't hold. Products of finite doubles times 256 stay below 2^2199."""
    return None if -LONG - 1 < score < LONG else (score + (1 << 2199)).to_bytes(276, "big")


class Block:
    """Queries of one width, with their best candidates so far."""

    def __init__(self, row, x: np.ndarray, k: int) -> None:
        self.row, self.x, self.k = np.asarray(row, np.int64), x, k
        self.best = [[] for _ in row]  # per query: (-score, id is NULL, id, row), best first
        self.order = np.argsort(-(x.astype(np.float64) ** 2).sum(axis=0), kind="stable")
        self.worst = np.full(len(row), -np.inf)
        q = x[:, self.order]
        self.most = float(np.abs(q).max(initial=0))
        self.q = q.astype(np.float64) if self.most < EXACT else None
        if self.q is not None:
            self.rest = [np.sqrt((self.q[:, a:] ** 2).sum(axis=1)) for a in range(STEP, x.shape[1], STEP)]

    def meet(self, rows: np.ndarray, ids: list, c: np.ndarray) -> None:
        """All candidates of a chunk (``c``: line by line) against all queries."""
        w = self.x.shape[1]
        if self.q is None or self.most * float(np.abs(c).max(initial=0)) * max(w, 1) >= EXACT:
            scores = self.x.astype(object) @ c.astype(object) if w else np.zeros((len(self.row), len(ids)), object)
            for i in range(len(self.row)):
                self.keep(i, [(int(s), j) for j, s in enumerate(scores[i])], rows, ids)
            return
        c = c[self.order].astype(np.float64)
        rest = [np.sqrt((c[a:] ** 2).sum(axis=0)) for a in range(STEP, w, STEP)]
        for t in range(0, len(self.row), TILE):
            at, ci, s = self.survivors(t, min(t + TILE, len(self.row)), c, rest)
            cut = np.flatnonzero(np.diff(at, prepend=-1, append=-1))
            for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                self.keep(t + int(at[a]), list(zip(s[a:b].astype(np.int64).tolist(), ci[a:b].tolist(), strict=True)), rows, ids)

    def survivors(self, t0: int, t1: int, c: np.ndarray, rest: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (query of the tile, candidate, score) that may be among the best, by query."""
        q, need, w = self.q[t0:t1], self.worst[t0:t1], len(c)
        part = q[:, :STEP] @ c[:STEP]
        at = ci = s = None  # pairs, once few are left
        for b in range(1, math.ceil(w / STEP)):
            a = b * STEP
            rq, rc = self.rest[b - 1][t0:t1] * (1 + 1e-9), rest[b - 1]
            if at is None:
                alive = part + rq[:, None] * rc[None, :] + 1 >= need[:, None]
                if np.count_nonzero(alive) * FEW > alive.size:
                    part += q[:, a : a + STEP] @ c[a : a + STEP]
                    continue
                at, ci = np.nonzero(alive)
                s = part[at, ci]
            else:
                alive = s + rq[at] * rc[ci] + 1 >= need[at]
                at, ci, s = at[alive], ci[alive], s[alive]
            s = s + np.einsum("ij,ji->i", q[at, a : a + STEP], c[a : a + STEP, ci])
        if at is None:
            least = np.maximum(need, np.partition(part, -self.k - 1, axis=1)[:, -self.k - 1] if part.shape[1] > self.k + 1 else -np.inf)
            at, ci = np.nonzero(part >= least[:, None])
            return at, ci, part[at, ci]
        alive = s >= need[at]
        return at[alive], ci[alive], s[alive]

    def keep(self, i: int, found: list[tuple[int, int]], rows: np.ndarray, ids: list) -> None:
        own = self.row[i]
        new = [(-s, ids[j] is None, ids[j] or 0, int(rows[j])) for s, j in found if rows[j] != own]
        if new:
            self.best[i] = sorted(self.best[i] + new)[: self.k]
            if len(self.best[i]) == self.k:
                self.worst[i] = -min(max(self.best[i][-1][0], -LONG), LONG)


def top_k(vectors: DataFrame, asked: Column, k: int, scale: int = SCALE, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` best candidates of every row of ``vectors`` (``vec_id``, ``embedding``) that ``asked`` holds for.

    Candidates are all rows but the query's own, of the query's width; equal scores go by ascending ``vec_id``, NULL last, then by
    place in the table. Rows that repeat are candidates each, and queries each. Vectors that are NULL or hold NULL or non-finite components take no
    part; an empty table gives no rows.
    """
    rows = stored(vectors.select("vec_id", "embedding").withColumn("row", F.monotonically_increasing_id()), "vectors")
    chunks = stored(chunked(rows, scale), "chunks")
    asking = stored(chunked(rows, scale, asked), "queries")
    tasks = -(-chunks.count() // CHUNKS)
    out = None
    for held in blocks(asking, F.length("ints"), query_bytes):
        found = search(chunks.repartition(max(tasks, 1)), held, k)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return rows.filter("false").select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score"))
    by = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("high").desc(), F.col("vec_id").asc_nulls_last(), "row")
    best = out.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def search(chunks: DataFrame, held: list, k: int) -> DataFrame:
    """Best ``k`` of each query in ``held`` (rows of :func:`chunked`), of each task."""
    queries = [(r.w, r.n, list(r.row), list(r.id), r.kind, bytes(r.ints)) for r in held]

    def meet(batches):
        made: dict[int, tuple[Block, list]] = {}
        for w in {q[0] for q in queries}:
            same = [q for q in queries if q[0] == w]
            x = np.concatenate([numbers(q[4], q[5], w, q[1]).T for q in same])
            made[w] = (Block([r for q in same for r in q[2]], x, k), [i for q in same for i in q[3]])
        for batch in batches:
            for w, n, row, ids, kind, ints in zip(*(batch.column(i) for i in range(6)), strict=True):
                if w.as_py() in made:
                    made[w.as_py()][0].meet(np.asarray(row.as_py(), np.int64), ids.as_py(), numbers(kind.as_py(), ints.as_py(), w.as_py(), n.as_py()))
        out = [
            (qid, int(block.row[i]), min(max(-s, -LONG - 1), LONG), beyond(-s), None if none else vid, row)
            for block, names in made.values() for i, qid in enumerate(names) for s, none, vid, row in block.best[i]
        ]
        frame = list(zip(*out, strict=True)) if out else [[]] * 6
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(frame, kinds, strict=True)], ["query_id", "query_row", "score", "high", "vec_id", "row"])

    return chunks.mapInArrow(meet, "query_id long, query_row long, score long, high binary, vec_id long, row long")


# floor and integer sums; the queries are the ids that 50 divides.
SQL = """
WITH good AS (
  SELECT vec_id, row_number() OVER () AS r, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM good q JOIN good c ON q.r <> c.r WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5"""


@query("op13_exact_top_k", SQL)
def op13(spark, folder):
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, 5)
