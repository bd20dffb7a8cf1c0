import numpy as np
import pytest

from wattloom.llm.embedding_dedup import near_duplicates


def brute(rows, threshold=0.93):
    ok = [r[2] is not None and r[1] is not None and len(r[1]) > 0 and all(a is not None and np.isfinite(a) for a in r[1]) and any(r[1]) for r in rows]
    unit = [np.array(r[1], float) / np.linalg.norm(np.array(r[1], float)) if k else None for r, k in zip(rows, ok)]
    comp, links = list(range(len(rows))), [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                if comp[i] != comp[j]:
                    comp = [comp[j] if c == comp[i] else c for c in comp]
    least = {}
    for r, c in zip(rows, comp):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    return sorted(((r[0], n, least.get(c, r[0]), least.get(c, r[0]) == r[0] and r[0] is not None) for r, n, c in zip(rows, links, comp)), key=repr)


def rows_of(seed, n=500, dim=16, spread=0.08):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n // 6, dim))
    rows = []
    for i in range(n):
        v = base[rng.integers(len(base))] if i % 3 else base[0]
        v = v / np.linalg.norm(v) + rng.standard_normal(dim) * (0 if i % 5 == 0 else spread / 2)
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(i % 7 == 6)))
    odd = [None, [], [0.0] * dim, [float("nan")] * dim, [float("inf")] + [1.0] * (dim - 1), [None] + [1.0] * (dim - 1), [1.0, 2.0], [2.0, 4.0]]
    return rows + [(n + k, v, 0) for k, v in enumerate(odd)] + [(None, rows[0][1], 0), (7, rows[7][1], rows[7][2]), (n + 50, rows[0][1], None)]


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("large", [4096, 40])
def test_recall_against_brute_force(spark, large):
    rows = rows_of(1)
    got = sorted((tuple(r) for r in near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), sample=200 if large == 40 else 16384, large=large).collect()), key=repr)
    want = brute(rows)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g[1] for g in got) >= 0.95 * sum(w[1] for w in want)
    assert sum(g == w for g, w in zip(got, want)) >= 0.9 * len(want)


def test_wide_data_with_one_leaf_is_exact(spark):
    rows = rows_of(2, 150)
    got = near_duplicates(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", v string").repartition(2))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = sorted(tuple(r) for r in near_duplicates(df).collect())
    want = brute([tuple(r) for r in df.select("vec_id", "embedding", "label").collect()])
    assert sum(g[1] for g in got) >= 0.9 * sum(w[1] for w in want) and all(g[1] <= w[1] for g, w in zip(got, want))


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
