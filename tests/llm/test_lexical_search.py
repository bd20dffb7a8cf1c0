import math
import random
import re

import numpy as np
import pytest

from wattloom.llm import lexical_search
from wattloom.llm.lexical_search import Strata, index, search, terms_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(t):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, k):
    lists = [(d, words(t)) for d, t in docs if words(t)]
    n, total = len(lists), sum(len(t) for _, t in lists)
    out = []
    for item, text in items:
        found = []
        for d, t in lists:
            m = 100 - 75 + (75 * len(t) * n) // total
            score = 0
            for term in words(text):
                df = sum(term in set(x) for _, x in lists)
                tf = t.count(term)
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, d is None, d or 0))
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def tables(spark, docs, items):
    return (
        spark.createDataFrame([(*r, 1, "x", 2) for r in docs], "doc_id long, text string, row int, term string, score int"),
        spark.createDataFrame([(*r, 9) for r in items], "item_id long, text string, row int"),
    )


def corpus(rnd, n):
    alphabet = [f"w{i}" for i in range(60)] + ["Été", "été", "你好", "naïve", "x1", "X1", "🙂"]
    say = lambda: "".join(rnd.choice(alphabet[: rnd.choice([5, 20, 67])]) + rnd.choice([" ", ", ", "-", "_", "\n", "\x7f"]) for _ in range(rnd.choice([1, 3, 10, 40, 200])))
    docs = [(i, say()) for i in range(n)]
    docs += [(n, docs[0][1]), (n, docs[0][1]), (None, docs[1][1]), (n + 1, None), (n + 2, ""), (n + 3, " -- !"), (n + 4, "w1 " * 3000)]
    rnd.shuffle(docs)
    items = [(i, say()) for i in range(8)] + [(8, None), (9, ""), (10, "unheard-of"), (0, "w1 w1 w2 été"), (None, "w3 你好")]
    return docs, items


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(spark, seed):
    docs, items = corpus(random.Random(seed), 120)
    d, i = tables(spark, docs, items)
    want = brute(docs, items, 5)
    for size, item_bytes in ((1 << 20, 1 << 20), (300, 200)):
        shards = index(d.repartition(3), size)
        got = sorted((tuple(r) for r in search(shards, i, 5, item_bytes).collect()), key=repr)
        assert got == want


def test_terms():
    for t in ("", "Aa-Bé_c9\x80d\x00É", "one\ttwo three", "MITK", None, " x"):
        assert [x.decode() for x in terms_of(t)] == words(t)


def test_bounds_end_the_visit_early(spark, monkeypatch):
    """Once long documents can't reach the list any more their postings are not touched."""
    docs = [(i, "rare " * 3 + "filler " * (i % 40)) for i in range(400)] + [(1000 + i, "rare " + "other " * 500 * (i + 1)) for i in range(30)]
    shards = index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1))
    touched = []
    real = lexical_search.ranges
    monkeypatch.setattr(lexical_search, "ranges", lambda s, n: touched.append(int(n.sum())) or real(s, n))
    rows = shards.collect()
    n, total = sum(r.n_docs for r in rows), sum(r.n_terms for r in rows)
    for r in rows:
        at = np.array([list(map(bytes, r.terms)).index(b"rare")])
        strata = Strata(r.ids, np.array(r.lengths), np.array(r.starts, np.int64), np.frombuffer(r.docs, np.int32), np.frombuffer(r.tfs, np.int32), at, n, total)
        touched.clear()
        found = strata.best(np.array([0]), np.array([7]), 10, [])
        assert len(found) == 10 and sum(touched[1:]) < r.n_docs


def test_ties_go_by_id(spark):
    d, i = tables(spark, [(k, "same words here") for k in (5, 3, 9, 1)] + [(7, "other")] * 9, [(1, "same")])
    assert [(r.rank, r.doc_id) for r in search(index(d), i, 3).orderBy("rank").collect()] == [(1, 1), (2, 3), (3, 5)]


def test_empty_tables(spark):
    d, i = tables(spark, [], [])
    full, item = tables(spark, [(1, "a b")], [(1, "a")])
    assert search(index(d), item).count() == 0 and search(index(full), i).count() == 0 and search(index(d), i).count() == 0
