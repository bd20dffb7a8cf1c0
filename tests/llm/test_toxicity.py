import random
import zlib

import pytest

from wattloom.llm.toxicity import Grammar, clause_matches, fit, scored, toxicity


def kinds(text, **insults):
    g = Grammar({"idiot": 1.0, "scu*": 2.0} | insults)
    return [(text[a:b], k) for a, b, k, _ in g.matches(text)]


def test_grammar_tells_clauses_apart():
    assert kinds("you are an idiot") == [("idiot", 1)]
    assert kinds("an idiot, you know") == [("idiot", 1)]
    assert kinds("an idiot. you know") == [("idiot", 0)]
    assert kinds("you are not an idiot") == [("idiot", 3)]
    assert kinds("he said you are an idiot") == [("idiot", 5)]
    assert kinds("i will kill you") == [("kill", 9)]
    assert kinds("scummy idiots idiot") == [("scummy", 0), ("idiot", 0)]
    assert kinds("") == [] and kinds("obscure") == []


def test_learns_words_and_beginnings(spark):
    clean = ["the sea is calm today", "a long road home", "rain in the hills"]
    docs = [(i, f"{clean[i % 3]} word{i % 7}" + (" you blargh" if i % 10 == 0 else f" zornq{chr(97 + i % 26)}{chr(97 + i % 23)}x" if i % 10 == 5 else "")) for i in range(300)]
    labels = [(i, None, int(i % 5 == 0)) for i in range(300)] + [(None, 1, 1), (9999, 1, 1), (3, 1, None)]
    d = spark.createDataFrame([(*x, 1.0) for x in docs] + [(None, None, 1.0), (7, "", 1.0), (7, "", 1.0)], "doc_id long, text string, score double").repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    g = fit(d, lab)
    assert "blargh" in g.insults and any(w.startswith("zorn") and w.endswith("*") for w in g.insults)
    out = toxicity(d, lab).collect()
    assert len(out) == 303 and all(0 <= r.score <= 1 for r in out)
    assert {r.doc_id for r in out if r.predicted} == {i for i, _ in docs if i % 5 == 0}
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    assert clause_matches(d, g).count() >= 60


def test_no_labels_and_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    d = spark.createDataFrame([(1, "you idiot"), (2, "fine")], "doc_id long, text string")
    assert [r.predicted for r in toxicity(d, none).orderBy("doc_id").collect()] == [1, 0]
    assert toxicity(d.limit(0), none).count() == 0


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_held_out_labels(spark, sf):
    d, lab = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity(d, lab).join(lab, "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r.toxic for r in rows)
    assert right >= 0.85 * len(rows)
    assert scored(d, Grammar(coefficients=[0.0] * 34), "doc_id", "lang").count() == d.count()


def test_rare_insults_among_many_frequent_clean_words(spark):
    rnd = random.Random(1)
    common = " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(13_000))
    docs = [(i, common + (" blargh" if i < 6 else "")) for i in range(40)]
    labels = [(i, int(i < 20)) for i in range(40)]
    g = fit(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert "blargh" in g.insults
