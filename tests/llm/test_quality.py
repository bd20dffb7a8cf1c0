import zlib

import numpy as np

from wattloom.llm.quality import DIM, KINDS, WORDS, attention, encode, fit, quality, train


def test_codes_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["Plain words, here.", None, "", "é ü\n" * 100, "a" * 1000, "!! ## " * 200, " x", "1 2 3", "\n\n"]
    x, bags = encode(texts)
    assert bags.tolist() == [1, 1, 1, 4, 1, 7, 1, 1, 1] and x.shape == (18, DIM)
    at = 0
    for t, n in zip(texts, bags):
        alone, k = encode([t])
        assert k.tolist() == [n] and np.allclose(alone, x[at : at + n], atol=1e-6)
        at += n
    assert not x[1].any() and not x[2].any() and not x[-1].any()
    one, _ = encode(["one two two Three"])
    assert np.isclose(one[0, KINDS + 1], 1 / 4) and np.isclose(one[0, KINDS + 2], 3 / 4) and np.isclose(one[0, KINDS], np.log1p(4))


def test_gradients():
    rng = np.random.default_rng(1)
    x, bags, y = rng.standard_normal((9, DIM)), np.array([2, 4, 3]), np.array([1.0, 0.0, 1.0])
    m = train(x, bags, y, np.ones(3), epochs=0)
    loss = lambda: float(-(y * np.log(m.attend(x, bags)[0]) + (1 - y) * np.log(1 - m.attend(x, bags)[0])).mean())
    before = loss()
    trained = train(x, bags, y, np.ones(3), epochs=60)
    m = trained
    assert loss() < 0.2 * before


def test_learns_which_passages_matter(spark):
    clean, junk = "calm words about the sea and the long road home . " * 30, "$$$ ### win %%% "
    docs = [(i, clean + (junk * 20 if i % 2 else "") + clean) for i in range(120)]
    labels = [(i, 1 - i % 2, 0) for i in range(120)] + [(None, 1, 0), (999, 0, 0)]
    d = spark.createDataFrame([(*x, 1) for x in docs] + [(None, None, 1), (4, "", 1), (4, "", 1)], "doc_id long, text string, score int").repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = quality(d, lab).collect()
    assert len(out) == 123 and all(0 <= r.score <= 1 for r in out)
    assert sum(r.predicted == 1 - r.doc_id % 2 for r in out if r.doc_id is not None and r.n_passages > 1) >= 118
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    weights = attention(d, fit(d, lab)).collect()
    assert np.isclose(sum(r.weight for r in weights), 123)
    assert sum(r.n_passages for r in out) == len(weights) and WORDS == 64


def test_no_labels_and_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    d = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    assert quality(d, none).first().score == 0.5 and quality(d.limit(0), none).count() == 0


def test_held_out_labels(spark):
    d, lab = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = quality(d, lab).join(lab, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.97 * len(rows)
