import random
import re

import pytest

from wattloom.llm.ngram_join import ngram_classes, one_of_each


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]) and comp[i] != comp[j]:
                comp = [comp[j] if c == comp[i] else c for c in comp]
    least = {}
    for (d, _), c in zip(rows, comp):
        if d is not None:
            least[c] = min(least.get(c, d), d)
    return sorted(((d, len(s), least.get(c, d)) for (d, _), s, c in zip(rows, sets, comp)), key=repr)


def corpus(seed, families=12, copies=9):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["Ünder", "ÉTÉ", "x\x0by", "a\xa0b"]
    line = " ".join(rnd.choice(words) for _ in range(12))
    rows, n = [], 0
    for f in range(families):
        base = [rnd.choice(words) for _ in range(rnd.randint(3, 80))]
        for _ in range(copies):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 5])):
                w[rnd.randrange(len(w))] = rnd.choice(words)
            text = " ".join(x.upper() if rnd.random() < 0.1 else x for x in w)
            rows.append((n, text + (f"\n{line}" if rnd.random() < 0.4 else "")))
            n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, "one two"), (n + 4, "ONE\ttwo"), (n + 5, "one"), (None, rows[0][1]), (5, rows[5][1]), (n + 6, "long " * 3000)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "bucket", "chunk"), [(1, 1_000_000, 2_000_000), (2, 200, 150)])
def test_components_equal_brute_force(spark, seed, bucket, chunk):
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, n long, key long").repartition(3)
    got = [tuple(r) for r in ngram_classes(docs, bucket, chunk).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_one_row_of_each_component(spark):
    rows = corpus(4)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, mark string").repartition(3)
    got = one_of_each(docs)
    assert got.columns == docs.columns
    blank = [r for r in rows if not shingles(r[1])]
    first = {c for _, n, c in brute(rows) if n}
    assert sorted((r.doc_id for r in got.collect() if shingles(r.text)), key=repr) == sorted(first, key=repr)
    assert sorted((r.doc_id for r in got.collect() if not shingles(r.text)), key=repr) == sorted((d for d, _ in blank), key=repr)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_classes(docs).count() == 0 and one_of_each(docs).count() == 0
