"""Jaccard self-join of word shingle sets by T-occurrence search (DivideSkip), and its components.

A document with ``n`` shingles needs ``T = ceil(0.75 n)`` of them in common with any partner. Its lists are ordered
by length; the ``n - T + 1`` shortest are merged, and whatever occurs there is looked up in the long ones by binary
search, until T is reached or out of reach. Four steps keep this distributed:

1. ``shingle_table``: size and digest of every set. Equal sets are one class from here on.
2. ``shared_lists``: list lengths. Shingles go by hash to buckets as packed arrays, a bucket counts sets per
   shingle, and only shingles with two or more come back. A class that has more shingles of its own than
   ``n - T`` has no partner and ends here. Shingles of a hundredth of all documents go to buckets by document
   instead, as their place in the order (last) is known from step 1; that list is bounded, see ``heavy``. Inside a bucket 40
   bits tell shingles apart; a false match is one shingle of two sets, and sets that can link share ``SMALLEST``.
3. ``blocks``: classes with a short list in common are connected; partners are always in one block.
4. ``search``: DivideSkip inside each block. Large blocks are cut into chunks which share pivots; afterwards
   only classes outside the block's largest component meet the other chunks. Pairs known to be connected are not
   looked up again, so a family of near copies costs little more than its size.

Nothing is capped or sampled: order, pivots and chunks change the work, not the links.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.base import query, stored, table
from wattloom.llm.graph import components
from wattloom.llm.shingles import set_key, shingle_sets, text_groups

THRESHOLD = 75  # per cent
WIDTH = 5
LOW = 40  # bits of a shingle's hash inside its bucket
COMMON = np.int64(1) << 40  # list length that stands for a heavy shingle
OFTEN = 0.005  # share of a batch from which a shingle is counted
SMALLEST = 3  # sets that differ and share 75 per cent of their union share three shingles at least


def needed(n):
    """Shingles that a partner of a set of ``n`` must share at least."""
    return -(-THRESHOLD * n // 100)


def shingle_table(docs: DataFrame) -> DataFrame:
    """Rows of documents (``doc_id``, ``mark``: hash of the text, ``n``, ``key``; no key without words) and, with NULL ``n``,
    shingles (``key``) that are frequent in some batch, with their number of documents there (``doc_id``)."""
    def sets(batches):
        for (ids, marks), texts in text_groups(batches):
            found = shingle_sets(texts, WIDTH)
            keys = [set_key(s) if len(s) else None for s in found]
            once = {k: s for k, s in zip(keys, found, strict=True) if k is not None}
            h, c = np.unique(np.concatenate([*once.values(), np.empty(0, np.uint64)]), return_counts=True)
            often = c >= max(4, OFTEN * len(once))
            none = [None] * int(often.sum())
            yield pa.RecordBatch.from_arrays([
                pa.array([*ids.to_pylist(), *c[often].tolist()], pa.int64()), pa.array([*marks.to_pylist(), *none], pa.int64()),
                pa.array([*map(len, found), *none], pa.int64()), pa.array([*keys, *h[often].view(np.int64).tolist()], pa.int64()),
            ], ["doc_id", "mark", "n", "key"])

    return docs.select("text", F.col("doc_id").cast("long"), F.xxhash64("text").alias("mark")).mapInArrow(sets, "doc_id long, mark long, n long, key long")


def heavy(made: DataFrame) -> np.ndarray:
    """Hashes of shingles that batches count in ``OFTEN`` of all documents: all that a hundredth of them hold, as batches below ``OFTEN``
    miss less than that share, and at most 200 times as many as a document has on average, whatever the number of documents."""
    found = made.filter("n IS NULL").groupBy("key").agg(F.sum("doc_id").alias("c"))
    total = made.filter("key IS NOT NULL AND n IS NOT NULL").count()
    rows = found.filter(F.col("c") >= max(8, total * OFTEN)).select("key").collect()
    return np.sort(np.array([r.key for r in rows], np.int64).view(np.uint64))


def _fold(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and place in it; together a shorter hash of ``LOW`` bits and the bucket's."""
    return ((h >> np.uint64(LOW)) % np.uint64(buckets)).astype(np.int64), h & np.uint64((1 << LOW) - 1)


def _pack(x: np.ndarray, size: int) -> bytes:
    """The low ``size`` bytes of each number, byte plane by byte plane: sorted or small numbers then compress."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T.tobytes()


def _unpack(b: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(b) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(b, np.uint8).reshape(size, -1).T
    return out.view("<u8").ravel()


_PACKED = "bucket int, batch long, kind int, a binary, b binary, c binary"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["bucket", "batch", "kind", "a", "b", "c"])


def shared_lists(docs: DataFrame, often: np.ndarray, postings: int, bucket_postings: int = 1_000_000) -> DataFrame:
    """Classes that may have partners: ``key``, ``n``, ``ids`` (shared shingles, shortest list first), ``short`` (how many of
    them to merge)."""
    buckets = max(8, postings // bucket_postings)

    def post(batches):
        for _, texts in text_groups(batches, 6 << 20):
            once = {}
            for s in shingle_sets(texts, WIDTH):
                if len(s):
                    once.setdefault(set_key(s), s)
            if not once:
                continue
            keys, sizes = np.fromiter(once, np.int64), np.array([len(s) for s in once.values()], np.int64)
            h, who = np.concatenate(list(once.values())), np.repeat(np.arange(len(keys), dtype=np.uint32), sizes)
            batch = set_key(keys)
            bucket, low = _fold(h, buckets)
            hot = np.isin(h, often)
            out = [(int(batch % buckets), batch, 0, keys.tobytes(), sizes.tobytes(), b"")]
            if hot.any():  # their place in the order is known: back to their documents by way of any bucket
                out.append((int((batch >> 8) % buckets), batch, 2, who[hot].tobytes(), (bucket[hot] << LOW | low[hot].astype(np.int64)).tobytes(), b""))
                bucket, low, who = bucket[~hot], low[~hot], who[~hot]
            order = np.lexsort((low, bucket))
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for k in np.flatnonzero(np.diff(cuts)):
                at = order[cuts[k] : cuts[k + 1]]
                out.append((int(k), batch, 1, _pack(low[at], LOW // 8), _pack(who[at], 4), b""))
            for i in range(0, len(out), 64):
                yield _rows(out[i : i + 64])

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        """One bucket: sets per shingle; back go those with two or more. A class in several batches counts in each, which
        only makes its lists look longer."""
        through = pdf[pdf.kind.isin([0, 2])]
        mine = pdf[pdf.kind == 1]
        if mine.empty:
            return through
        low = np.concatenate([_unpack(x, LOW // 8) for x in mine.a])
        doc = np.concatenate([_unpack(x, 4) for x in mine.b]).astype(np.uint32)
        batch = np.repeat(mine.batch.to_numpy(), [len(x) // 4 for x in mine.b])
        order = np.argsort(low, kind="stable")
        low, batch, doc = low[order], batch[order], doc[order]
        head = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
        size = np.diff(np.r_[head, len(low)])
        size = np.repeat(size, size)
        keep = size > 1
        low, batch, doc, size = low[keep], batch[keep], doc[keep], size[keep]
        order = np.argsort(batch, kind="stable")
        heads = np.flatnonzero(np.r_[True, batch[order][1:] != batch[order][:-1]]) if len(batch) else []
        k = int(mine.bucket.iloc[0])
        out = []
        for a, b in zip(heads, [*heads[1:], len(order)], strict=True) if len(heads) else []:
            at = order[a:b]
            out.append((k, int(batch[at[0]]), 1, _pack(doc[at], 4), _pack(low[at], LOW // 8), _pack(np.minimum(size[at], 2**31 - 1), 4)))
        return pd.concat([through, pd.DataFrame(out, columns=list(through.columns))])

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        """One batch: for each class its shared shingles in order, if there are enough of them."""
        table_rows = pdf[pdf.kind == 0]
        keys, sizes = np.frombuffer(table_rows.a.iloc[0], np.int64), np.frombuffer(table_rows.b.iloc[0], np.int64)
        doc, ids, size = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for r in pdf.itertuples():
            if r.kind == 1:
                doc.append(_unpack(r.a, 4).astype(np.int64))
                ids.append(np.int64(r.bucket) << LOW | _unpack(r.b, LOW // 8).astype(np.int64))
                size.append(_unpack(r.c, 4).astype(np.int64))
            elif r.kind == 2:
                doc.append(np.frombuffer(r.a, "<u4").astype(np.int64))
                ids.append(np.frombuffer(r.b, np.int64))
                size.append(np.full(len(ids[-1]), COMMON))
        doc, ids, size = map(np.concatenate, (doc, ids, size))
        order = np.lexsort((ids, size, doc))
        doc, ids = doc[order], ids[order]
        once = np.r_[True, (doc[1:] != doc[:-1]) | (ids[1:] != ids[:-1])] if len(doc) else []
        doc, ids = doc[once], ids[once]  # two batches of the same classes have one number
        cuts = np.searchsorted(doc, np.arange(len(keys) + 1))
        out = []
        for i, (key, n) in enumerate(zip(keys.tolist(), sizes.tolist(), strict=True)):
            shared = int(cuts[i + 1] - cuts[i])
            if n >= SMALLEST and shared >= needed(n):
                out.append((key, n, ids[cuts[i] : cuts[i + 1]], shared - needed(n) + 1))
        return pd.DataFrame(out, columns=["key", "n", "ids", "short"])

    posted = docs.select("text").mapInArrow(post, _PACKED)
    counted = posted.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(count, _PACKED)
    found = counted.groupBy("batch").applyInPandas(gather, "key long, n long, ids array<long>, short int")
    # A class in several batches comes from each, with the same lists.
    best = found.groupBy("key").agg(F.max_by(F.struct("n", "ids", "short"), F.size("ids")).alias("x"))
    return best.select("key", "x.*")


def blocks(lists: DataFrame) -> DataFrame:
    """``key``, ``block``: classes that a short list connects."""
    posted = stored(lists.select("key", F.explode(F.slice("ids", F.lit(1), F.col("short"))).alias("id")), "short-lists")
    hubs = stored(posted.groupBy("id").agg(F.min("key").alias("hub"), F.count("*").alias("m")).filter("m > 1").select("id", "hub"), "hubs")
    edges = posted.join(hubs, "id").filter("key <> hub").select(F.col("key").alias("src"), F.col("hub").alias("dst")).distinct()
    return components(edges).withColumnsRenamed({"node": "key", "component": "block"})


def divide_skip(sets: list[np.ndarray], sizes: np.ndarray, group: np.ndarray | None = None, limit: int = 256) -> np.ndarray:
    """Component of each set, as the index of one of its members.

    ``sets`` hold shared shingles in one common order, rare ones first. Two sets link when they share at least 75
    per cent of their union. ``group``: sets with the same number (-1: none) are taken as connected.
    """
    m = len(sets)
    comp = np.arange(m)
    if group is not None:
        named = np.where(group < 0, group.max(initial=0) + 1 + comp, group)
        _, first, code = np.unique(named, return_index=True, return_inverse=True)
        comp = first[code]
    order = np.argsort(comp, kind="stable")
    heads = np.flatnonzero(np.r_[True, comp[order][1:] != comp[order][:-1]]) if m else []
    members = {int(comp[x[0]]): x.tolist() for x in np.split(order, heads[1:])} if m else {}
    flat, owner = np.concatenate(sets), np.repeat(np.arange(m), [len(s) for s in sets])
    ids, code = np.unique(flat, return_inverse=True)
    by = np.argsort(code, kind="stable")
    cut = np.searchsorted(code[by], np.arange(len(ids) + 1))
    lists, length = owner[by], np.diff(cut)
    at = np.r_[0, np.cumsum([len(s) for s in sets])]
    for q in range(m):
        mine = code[at[q] : at[q + 1]]
        mine = mine[np.argsort(length[mine], kind="stable")]
        n, t = int(sizes[q]), int(needed(sizes[q]))
        if len(mine) < t:
            continue
        short, long_ = mine[: len(mine) - t + 1], mine[len(mine) - t + 1 :]
        merged = [lists[cut[c] : cut[c + 1]] for c in short]
        if sum(map(len, merged)) <= limit:
            hits: dict[int, int] = {}
            for d in heapq.merge(*[x.tolist() for x in merged]):
                if d < q:
                    hits[d] = hits.get(d, 0) + 1
            seen = np.fromiter(hits, int, len(hits))
            have = np.fromiter(hits.values(), int, len(hits))
        else:  # the same merge as counts, for lists too long for a heap in Python
            counts = np.bincount(np.concatenate(merged), minlength=m)
            seen = np.flatnonzero(counts[:q])
            have = counts[seen]
        ok = (comp[seen] != comp[q]) & (100 * np.minimum(sizes[seen], n) >= THRESHOLD * np.maximum(sizes[seen], n))
        seen, have = seen[ok], have[ok]
        for d, overlap in zip(seen.tolist(), have.tolist(), strict=True):
            if comp[d] == comp[q]:
                continue
            # 100 i >= 75 (n + m - i)
            t2 = -(-THRESHOLD * (n + int(sizes[d])) // (100 + THRESHOLD))
            for k, c in enumerate(long_):
                if overlap >= t2 or overlap + len(long_) - k < t2:
                    break
                a, b = int(cut[c]), int(cut[c + 1])
                i = bisect_left(lists, d, a, b)
                overlap += i < b and lists[i] == d
            if overlap >= t2:
                # The smaller component takes the other's name, so each set is renamed a logarithm of times.
                a, b = sorted((int(comp[q]), int(comp[d])), key=lambda c: len(members[c]))
                comp[members[a]] = b
                members[b] += members.pop(a)
    return comp


def search(lists: DataFrame, placed: DataFrame, chunk_postings: int = 2_000_000, pivots: int = 16) -> DataFrame:
    """``key``, ``component`` of every class in a block."""
    weights = placed.join(lists.select("key", F.size("ids").alias("w")), "key")
    cuts = stored(weights.groupBy("block").agg(F.ceil(F.sum("w") / chunk_postings).cast("int").alias("chunks"), F.count("*").alias("members")), "block-sizes")
    members = stored(
        stored(placed.join(lists, "key"), "members").join(cuts, "block").withColumn("chunk", F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int")), "chunks")

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([one(part) for _, part in pdf.groupby(["block", "chunk"])])

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("key").sort_values(["n", "key"])
        group = pdf.group.to_numpy() if "group" in pdf else None
        if group is not None:
            group = np.where(group == 0, -1, pd.factorize(group)[0])
        comp = divide_skip([np.asarray(x, np.int64) for x in pdf.ids], pdf.n.to_numpy(), group)
        keys = pdf.key.to_numpy()
        best = pd.Series(keys).groupby(comp).transform("min").to_numpy()
        return pd.DataFrame({"src": keys, "dst": best})

    def linked(parts: DataFrame) -> DataFrame:
        """Many small chunks in one group, a large one among few."""
        binned = parts.withColumn("bin", F.pmod(F.xxhash64("block", "chunk"), F.lit(bins)))
        return stored(binned.groupBy("bin").applyInPandas(link, "src long, dst long"), "links")

    own = members.select("block", "chunk", "key", "n", "ids")
    bins = max(1, (weights.agg(F.sum("w")).first()[0] or 0) // (chunk_postings // 4))
    many = members.filter("chunks > 1")
    share = many.filter(F.pmod(F.xxhash64(F.col("key"), F.lit(7)), F.greatest(F.lit(1), (F.col("members") / pivots).cast("int"))) == 0)
    shared = share.select("block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "key", "n", "ids")
    local = linked(own.union(shared))
    if cuts.filter("chunks > 1").isEmpty():
        return local.withColumnsRenamed({"src": "key", "dst": "component"})
    first = components(local)
    # Classes outside their block's largest component against the other chunks.
    known = stored(many.join(first.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key")), "known")
    by_comp = known.groupBy("block", "component").count()
    largest = stored(by_comp.groupBy("block").agg(F.max_by("component", "count").alias("largest")), "largest")
    asks = known.join(largest, "block").filter("component <> largest")
    asks = asks.select("block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "key", "n", "ids", F.col("component").alias("group"))
    rest = known.select("block", "chunk", "key", "n", "ids", F.col("component").alias("group"))
    across = linked(rest.union(asks))
    return components(local.union(across)).withColumnsRenamed({"node": "key"})


def classed(docs: DataFrame, bucket_postings: int = 1_000_000, chunk_postings: int = 2_000_000) -> DataFrame:
    """Stored table of ``doc_id``, ``mark`` (hash of the text), ``n``, ``root`` (equal within a component, NULL without shingles)."""
    made = stored(shingle_table(docs), "shingles")
    rows = made.filter("n IS NOT NULL")
    postings = rows.agg(F.sum("n")).first()[0] or 0
    lists = stored(shared_lists(docs, heavy(made), postings, bucket_postings), "lists")
    roots = stored(search(lists, stored(blocks(lists), "blocks"), chunk_postings), "roots")
    root = F.coalesce("component", "key").alias("root")
    return stored(rows.join(roots, "key", "left").select("doc_id", "mark", "n", root), "classed")


def ngram_classes(docs: DataFrame, bucket_postings: int = 1_000_000, chunk_postings: int = 2_000_000) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` for every row of ``docs`` (``doc_id``, ``text``; other columns are not read).

    NULL, empty and blank texts have no shingles and a component of their own. Rows that repeat are
    rows of the result each; a row without ``doc_id`` is linked like the others and never names a component that has an id.
    """
    rows = classed(docs, bucket_postings, chunk_postings)
    least = stored(rows.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least")), "least")
    return rows.join(least, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of every component, that of the smallest ``doc_id``, with all columns; texts without shingles all stay."""
    rows = classed(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("r")
    keep = rows.filter("root IS NOT NULL").groupBy("root").agg(first).select(F.col("r.doc_id").alias("__id"), F.col("r.mark").alias("__mark"))
    marked = docs.withColumn("__at", F.xxhash64("text"))
    blank = F.coalesce(F.col("text"), F.lit("")).rlike(r"^[\x20\x09-\x0D]*\z")
    hit = marked.filter(~blank).join(stored(keep, "keep"), F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__at") == F.col("__mark")))
    return hit.dropDuplicates(["__id", "__mark"]).select(*docs.columns).union(docs.filter(blank))


@query("op2_ngram_jaccard_join")
def op2(spark, folder):
    return ngram_classes(table(spark, folder, "documents"))
