"""Near-duplicate embeddings by a forest of random-projection trees.

Equal vectors with equal labels are one class first, with a count. A tree splits by the projection on a random direction at a random
quantile near the median; vectors within a margin of the split go to both sides (spill). Several trees split differently, so a
close pair that one tree parts meets in another. Classes of a leaf are compared exactly; nothing is compared across labels.

A forest is fitted on a bounded sample and routes every row. Leaves that are still large are split again by a forest
of their own, fitted on a sample of that leaf, until they are small or no longer shrink, so depth follows
the data. What then is still large (a cluster of near copies) is compared in pairs of blocks: every block of the
leaf with itself and each other one, so no task holds the leaf.

A pair that meets in several leaves counts in the first only: rows carry the list of their leaves, so a
task can tell without a shuffle of pairs. Tasks put out one number per vector, and links enough to connect what is connected.
"""

from __future__ import annotations

import pickle
from itertools import takewhile

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.base import query, stored, table
from wattloom.llm.graph import components

COSINE = 0.93
TREES = 8
LEAF = 256  # sampled vectors in a leaf
SAMPLE = 16_384  # vectors that fit one forest
SPILL = 0.015  # margin on either side of a split, in units of a unit vector's length
TRIES, OVERLAP = 12, 1.25  # splits tried at a node, and rows of both sides over its own at most
LARGE = 4096  # classes in a leaf that is split again, and in a block
ROUNDS = 6


def fit_tree(x: np.ndarray, rng: np.random.Generator, leaf: int = LEAF, depth: int = 40) -> list[tuple]:
    """Nodes ``(direction, threshold, low child, high child)``; a leaf is a negative child. Directions come from ``rng`` alone."""
    nodes: list = []
    leaves = 0

    def grow(at: np.ndarray, level: int) -> int:
        nonlocal leaves
        if len(at) > leaf and level < depth:
            for _ in range(TRIES):
                w = rng.standard_normal(x.shape[1])
                w /= np.linalg.norm(w)
                p = x[at] @ w
                t = float(np.quantile(p, rng.uniform(0.3, 0.7)))
                low, high = at[p <= t + SPILL], at[p > t - SPILL]
                # A split through a cluster of near copies would send most of it both ways.
                if len(low) + len(high) <= OVERLAP * len(at) and max(len(low), len(high)) < 0.95 * len(at):
                    n = len(nodes)
                    nodes.append(None)
                    nodes[n] = (w, t, grow(low, level + 1), grow(high, level + 1))
                    return n
        leaves += 1
        return -leaves

    root = grow(np.arange(len(x)), 0)
    return nodes if root >= 0 else []


def route(nodes: list[tuple], x: np.ndarray) -> list[list[int]]:
    """Leaves (numbers from 1) of every row."""
    out: list[list[int]] = [[] for _ in range(len(x))]
    if not nodes:
        return [[1] for _ in range(len(x))]
    stack = [(0, np.arange(len(x)))]
    while stack:
        n, at = stack.pop()
        if not len(at):
            continue
        if n < 0:
            for i in at.tolist():
                out[i].append(-n)
            continue
        w, t, low, high = nodes[n]
        p = x[at] @ w
        stack += [(low, at[p <= t + SPILL]), (high, at[p > t - SPILL])]
    return out


def fit_forest(x: np.ndarray, seed: int, trees: int) -> list[list[tuple]]:
    return [fit_tree(x, np.random.default_rng([seed & (2**63 - 1), k])) for k in range(trees)]


def unit(rows) -> np.ndarray:
    x = np.array([np.asarray(r, np.float64) for r in rows])
    x = x.reshape(len(rows), -1)
    scale = np.abs(x).max(axis=1, keepdims=True)
    x = x / scale
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def all_rows(vectors: DataFrame, whole: bool = False) -> DataFrame:
    """``vec_id`` and ``class`` (NULL where the row links with nothing) of every row; ``whole``: also ``label`` and ``v``."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) < float("inf")))
    good = F.col("label").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda a: a != 0)
    rows = rows.withColumn("class", F.when(F.coalesce(good, F.lit(False)), F.xxhash64("label", "v")))
    return rows if whole else rows.select("vec_id", "class")


def planted(found: DataFrame, trees: int, sample: int, large: int) -> DataFrame:
    """``class``, ``tree``, ``leaf`` for every leaf that a class falls into; leaf numbers include label and width."""
    width = F.size("v")
    forests = {}
    for w in [r.w for r in found.select(width.alias("w")).distinct().orderBy("w").limit(1000).collect()]:
        rows = found.filter(width == w).select("v").orderBy(F.xxhash64("class"), "class").limit(max(1, min(sample, sample * 64 // w))).collect()
        forests[w] = fit_forest(unit([r.v for r in rows]), w, trees)

    def send(parts):
        for pdf in parts:
            out = []
            for (label, w), rows in pdf.assign(w=pdf.v.map(len)).groupby(["label", "w"]):
                x, names = unit(rows.v), rows["class"].to_numpy()
                for k in range(trees):
                    got = route(forests[w][k] if w in forests else [], x)
                    out += [(c, k, label, w, leaf) for c, leaves in zip(names, got, strict=True) for leaf in leaves]
            if out:
                yield pd.DataFrame(out, columns=["class", "tree", "label", "w", "n"])

    sent = found.select("class", "label", "v").mapInPandas(send, "class long, tree int, label string, w int, n int")
    placed = stored(sent.select("class", "tree", F.xxhash64("label", "w", "tree", "n").alias("leaf")), "leaves")
    for level in range(ROUNDS):
        sizes = stored(placed.groupBy("leaf").count().filter(F.col("count") > large), "large")
        if sizes.isEmpty():
            break
        again = split_large(found, placed.join(sizes, "leaf"), sample, level, large)
        placed = stored(placed.join(sizes, "leaf", "left_anti").select("class", "tree", "leaf").union(again), "leaves")
    return placed


def split_large(found: DataFrame, rows: DataFrame, sample: int, level: int, large: int) -> DataFrame:
    """Leaves of rows (``class``, ``tree``, ``leaf``, ``count``) of large leaves, split by a tree of their own each."""
    # A share of each leaf by hash, about ``sample`` rows at most: the sample of one leaf fits one task.
    chance = F.pmod(F.xxhash64("class", F.lit(level)), F.lit(1 << 20)) < F.least(F.lit(1 << 20), (F.lit(float(1 << 20)) * sample / 4 / F.col("count")))
    picked = rows.filter(chance).join(found.select("class", "v"), "class").select("leaf", "v")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        leaf = int(pdf.leaf.iloc[0])
        return pd.DataFrame({"leaf": [leaf], "nodes": [pickle.dumps(fit_tree(unit(pdf.v), np.random.default_rng([leaf & (2**63 - 1), level])))]})

    fitted = stored(picked.groupBy("leaf").applyInPandas(fit, "leaf long, nodes binary"), "trees")
    chunk = F.pmod(F.xxhash64("class", F.lit(level + 99)), F.ceil(F.col("count") / large).cast("long"))
    parts = rows.withColumn("chunk", chunk).join(found.select("class", "v"), "class").join(fitted, "leaf")

    def send(pdf: pd.DataFrame) -> pd.DataFrame:
        got = route(pickle.loads(pdf.nodes.iloc[0]), unit(pdf.v))
        return pd.DataFrame([(c, t, n) for c, t, leaves in zip(pdf["class"], pdf.tree, got, strict=True) for n in leaves], columns=["class", "tree", "n"]).assign(leaf=int(pdf.leaf.iloc[0]))

    out = parts.groupBy("leaf", "chunk").applyInPandas(send, "class long, tree int, n long, leaf long")
    return out.select("class", "tree", F.xxhash64("leaf", "n").alias("leaf"))


def compare(found: DataFrame, placed: DataFrame, threshold: float, block: int) -> DataFrame:
    """``class``, ``links`` (rows in other classes, in parts to be added) and ``to`` (classes to connect)."""
    leaves = placed.groupBy("class").agg(F.array_sort(F.collect_set(F.struct("tree", "leaf"))).alias("all"))
    sizes = stored(placed.groupBy("leaf").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"), F.count("*").alias("n")).filter("n > 1"), "leaf-sizes")
    full = stored(found.join(leaves, "class").select("class", "v", "m", F.transform("all", lambda s: s["leaf"]).alias("all")), "rows")
    rows = placed.select("class", "leaf").distinct().join(sizes, "leaf").withColumn("b", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    # Block pairs (i, j), i <= j: a row of block b stands in every pair that names b.
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("b", o).alias("i"), F.greatest("b", o).alias("j")))
    rows = rows.select("class", "leaf", "b", F.explode(pair).alias("p")).select("class", "leaf", "b", "p.*").join(full, "class")

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        leaf, i, j = int(pdf.leaf.iloc[0]), int(pdf.i.iloc[0]), int(pdf.j.iloc[0])
        a = pdf[pdf.b == i]
        b = pdf[pdf.b == j]
        xa, xb = unit(a.v) if len(a) else None, unit(b.v) if len(b) else None
        if xa is None or xb is None:
            return pd.DataFrame({"class": [], "links": [], "to": []}, dtype="int64")
        ma, mb, ca, cb = a.m.to_numpy(), b.m.to_numpy(), a["class"].to_numpy(), b["class"].to_numpy()
        # An earlier common leaf (in the order of the lists) counts the pair instead.
        early_a, early_b = ([list(takewhile(lambda t: t != leaf, x)) for x in side["all"]] for side in (a, b))
        comp = np.arange(len(a) + len(b)) if i != j else np.r_[np.arange(len(a)), np.arange(len(a))]
        seen: dict[int, list[int]] = {}
        for n, x in enumerate(early_b):
            for t in x:
                seen.setdefault(t, []).append(n)
        na, nb = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        for r in range(0, len(a), 512):
            near = xa[r : r + 512] @ xb.T
            hit = near >= threshold
            if i == j:
                hit &= np.arange(r, r + len(near))[:, None] < np.arange(len(b))[None, :]
            # Products of matrices round differently from case to case: close calls are decided by plain sums.
            for p, q in zip(*np.nonzero(np.abs(near - threshold) < 1e-12), strict=True):
                if i != j or p + r < q:
                    hit[p, q] = cosine(a.v.iloc[p + r], b.v.iloc[q]) >= threshold
            if not hit.any():
                continue
            fresh = hit.copy()
            for p in np.flatnonzero(hit.any(axis=1)).tolist():
                for t in early_a[p + r]:
                    if t in seen:
                        fresh[p, seen[t]] = False
            na[r : r + 512] += fresh @ mb
            nb += ma[r : r + 512] @ fresh
            for p in np.flatnonzero(hit.any(axis=1)).tolist():
                joined = np.unique(comp[len(a) + np.flatnonzero(hit[p])])
                if len(joined) > 1 or joined[0] != comp[p + r]:
                    comp[np.isin(comp, joined)] = comp[p + r]
        names = np.r_[ca, cb]
        to = pd.Series(names).groupby(comp).transform("min").to_numpy()
        out = pd.DataFrame({"class": names, "links": np.r_[na, nb], "to": to})
        return out[(out.links > 0) | (out["class"] != out.to)]

    return rows.groupBy("leaf", "i", "j").applyInPandas(meet, "class long, links long, to long")


def cosine(a, b) -> float:
    a, b = (unit([v])[0] for v in (a, b))
    return float(np.sum(a * b))


def near_duplicates(vectors: DataFrame, threshold: float = COSINE, trees: int = TREES, sample: int = SAMPLE, large: int = LARGE) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` of every row of ``vectors`` (``vec_id``, ``embedding``, ``label``).

    Rows with equal vectors and labels link with each other whatever the trees do. Vectors that are NULL, zero or hold NULL or
    non-finite parts, and rows without label, link with nothing. Vectors of different width are not compared.
    """
    good = all_rows(vectors, True).filter("class IS NOT NULL")
    found = stored(good.groupBy("class").agg(F.first("label").alias("label"), F.first("v").alias("v"), F.count("*").alias("m"), F.min("vec_id").alias("first")), "classes")
    met = stored(compare(found, planted(found, trees, sample, large), threshold, large), "met")
    links = met.groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(met.select(F.col("class").alias("src"), F.col("to").alias("dst")))
    info = found.select("class", "m", "first").join(links, "class", "left").join(roots.withColumnRenamed("node", "class"), "class", "left")
    info = stored(info.select("class", "first", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n"), F.coalesce("component", "class").alias("root")), "info")
    least = stored(info.groupBy("root").agg(F.min("first").alias("least")), "least")
    told = stored(info.join(least, "root").select("class", "n", "least"), "told")
    rows = stored(all_rows(vectors), "rows")
    out = rows.join(told, "class", "left")
    component = F.coalesce("least", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))


@query("op6_embedding_near_dedup")
def op6(spark, folder):
    return near_duplicates(table(spark, folder, "embeddings"))
