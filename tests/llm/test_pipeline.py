import numpy as np

import corpus_pipeline
from wattloom.llm.decontaminate import Index, regions_of
from wattloom.llm.packing import Encoder, piece_bounds, tokenizer_file
from wattloom.llm.toxicity import crc_mod, fit

from .test_ngram_join import shingles
from .test_secrets import brute as secret_spans

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def mask(text):
    spans = sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in secret_spans(text)[-1].split(",") if s))
    order = ["assign", "access", "hex", "endpoint", "account", "key"]
    out, at = "", 0
    for a, b, k in sorted(spans, key=lambda s: (s[0], order.index(s[2]), s[1])):
        if a >= at:
            out += text[at:a] + f"[{k.upper()}]"
        at = max(at, b)
    return out + text[at:]


def plain(spark):
    """The stages on driver lists."""
    docs, labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    grammar = fit(docs, labels.filter(crc_mod(4) != 2))
    rows = sorted(r for r in ((r.doc_id, r.text) for r in docs.collect()) if grammar.score(r[1]) < 0.3)
    sets, comp = [shingles(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                comp = [comp[j] if c == comp[i] else c for c in comp]
    seen, kept = set(), []
    for (d, t), c in zip(rows, comp):
        if c not in seen:
            kept.append((d, t))
        seen.add(c)
    index = Index([(r.item_id, r.text) for r in bench.collect()])
    kept = [x for x, (_, found) in zip(kept, regions_of([t for _, t in kept], index)) if not found]
    return [(d, mask(t)) for d, t in kept]


def test_pipeline_equals_plain_version(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    want, model = plain(spark), Encoder(tokenizer_file())
    ids = {d: np.append(np.frombuffer(x, "<u4"), 0) for (d, _), x in zip(want, model.encode([t for _, t in want]))}
    assert 0 < len(want) < 200
    pieces = {(d, k, s, n) for d, x in ids.items() for k, (s, n) in enumerate(piece_bounds(len(x), 2048))}
    assert {(r.doc_id, r.piece, r.start, r.length) for r in got} == pieces and len(got) == len(pieces)


def test_stages_return_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(20), SF).columns == COLUMNS


def test_odd_rows_pass_all_stages(spark):
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "word", None, "s", 4), (2, "word", None, "s", 4)], "doc_id long, text string, lang string, source string, n_chars long")
    for some in (docs, docs.limit(0)):
        out = some
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, out, SF)
        assert out.count() == (4 if some is docs else 0)
