import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattloom.llm import vector_search
from wattloom.llm.vector_search import Block, top_k


def whole(x):
    n, d = float(x).as_integer_ratio()
    return n * 256 // d


def brute(rows, k, asked):
    """``rows``: (vec_id, vector) by place."""
    good = [(i, r[0], [whole(x) for x in r[1]]) for i, r in enumerate(rows) if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    out = []
    for i, name, q in good:
        if name is None or not asked(name):
            continue
        met = sorted((-sum(a * b for a, b in zip(q, c, strict=True)), other is None, other or 0) for j, other, c in good if j != i and len(c) == len(q))
        out += [(name, n, None if none else other, min(max(-s, -2**63), 2**63 - 1)) for n, (s, none, other) in enumerate(met[:k], 1)]
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, 1.5) for r in rows], "vec_id long, embedding array<double>, row int, score double")


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def clusters(rnd, n, width):
    centres = [[rnd.gauss(0, 0.3) for _ in range(width)] for _ in range(5)]
    return [(i, [c + rnd.gauss(0, 0.05) for c in rnd.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize("width", [1, 5, 40])
def test_equals_brute_force(spark, width, monkeypatch):
    rnd = random.Random(width)
    rows = clusters(rnd, 300, width)
    rows += [(300, rows[3][1]), (301, rows[3][1]), (302, [0.0] * width), (None, rows[5][1])]
    rows += [(350, None), (400, [None] * width), (450, [float("nan")] * width), (500, [float("inf")] * width), (550, [1.0] * (width + 1)), (600, [])]
    rnd.shuffle(rows)
    want = brute(rows, 3, lambda i: i % 10 == 0)
    df = frame(spark, rows).repartition(3)
    assert got(top_k(df, F.col("vec_id") % 10 == 0, 3)) == want
    assert got(top_k(df, F.col("vec_id") % 10 == 0, 3, query_bytes=200)) == want


def test_pruned_search_equals_all_products():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 64)) * 40
    x = np.floor(centres[rng.integers(0, 20, 3000)] + rng.normal(size=(3000, 64)) * 4).astype(np.int64)
    block = Block(np.arange(50), x[:50], 5)
    for a in range(0, 3000, 500):
        block.meet(np.arange(a, a + 500), list(range(a, a + 500)), np.ascontiguousarray(x[a : a + 500].T))
    scores = x[:50] @ x.T
    for i in range(50):
        want = sorted((-int(s), j) for j, s in enumerate(scores[i]) if j != i)[:5]
        assert [(b[0], b[2]) for b in block.best[i]] == want


def test_most_candidates_are_compacted_away(monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(50, 128)) * 40
    x = np.floor(centres[rng.integers(0, 50, 4000)] + rng.normal(size=(4000, 128)) * 2).astype(np.int64)
    block, pairs = Block(np.arange(64), x[:64], 5), []
    real = np.einsum
    monkeypatch.setattr(vector_search.np, "einsum", lambda *a: pairs.append(len(a[1])) or real(*a))
    for a in range(0, 4000, 1000):
        block.meet(np.arange(a, a + 1000), list(range(a, a + 1000)), np.ascontiguousarray(x[a : a + 1000].T))
    assert pairs and max(pairs) < 64 * 1000 / 8 and pairs[-1] < 64 * 1000 / 20


def test_ties_repeated_rows_and_few_candidates(spark):
    rows = [(0, [1.0, 1.0]), (50, [1.0, 1.0]), (50, [1.0, 1.0]), (7, [1.0, 1.0]), (3, [1.0, 1.0])]
    assert got(top_k(frame(spark, rows), F.col("vec_id") % 50 == 0, 3)) == brute(rows, 3, lambda i: i % 50 == 0)
    assert got(top_k(frame(spark, rows[:1]), F.col("vec_id") % 50 == 0, 3)) == []


def test_large_numbers_are_exact(spark):
    rows = [(0, [1e17, 3.0, -2.0]), (50, [1e17, 3.0, -2.0]), (1, [1e17, 3.0, -1.0]), (2, [-1e300, 0.5, 1.0]), (3, [1e7 + 0.5, 2.0, 3.0]), (100, [1e7 + 1.5, 2.0, 3.0]), (4, [1e7, 2.0, 3.0])]
    assert got(top_k(frame(spark, rows), F.col("vec_id") % 50 == 0, 4)) == brute(rows, 4, lambda i: i % 50 == 0)


def test_empty_table(spark):
    assert got(top_k(frame(spark, []), F.col("vec_id") % 50 == 0, 5)) == []
    assert got(top_k(frame(spark, [(1, [1.0])]), F.col("vec_id") % 50 == 0, 5)) == []
