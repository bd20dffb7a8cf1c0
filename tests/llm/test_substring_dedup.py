import random

import pytest

from wattloom.llm.substring_dedup import deduplicated, normal, report, units


def pieces(t):
    ends = units(t)
    return list(zip([0, *ends[:-1]], ends, strict=True)) if ends else []


def brute(rows, least):
    """Gaps and islands over all units, in plain order."""
    seen, out = set(), {}
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i)):
        t = rows[i][1] or ""
        listed = [(s, e, normal(t[s:e])) for s, e in pieces(t)]
        listed = [u for u in listed if u[2]]
        spans, n, run = [], 0, []
        for u in [*listed, None]:
            if u is not None and u[2] in seen:
                run.append(u)
                continue
            if u is not None:
                seen.add(u[2])
            if run and sum(len(x[2]) for x in run) >= least:
                spans.append((run[0][0], run[-1][1]))
                n += len(run)
            run = []
        out[i] = (rows[i][0], len(listed), n, sum(e - s for s, e in spans), ",".join(f"{s}:{e}" for s, e in spans))
    return [out[i] for i in range(len(rows))]


def corpus():
    rnd = random.Random(2)
    line = lambda: " ".join(rnd.choice("abc. de fgh! é ÜB 🙂 你好。".split()) for _ in range(rnd.randint(1, 7)))
    common = ["Common line that stands in many texts", "  common\tline that  STANDS in many texts ", "第一句。第二句很长很长！第三句。", "One. Two!  Three?\tFour…"]
    rows = [(i, rnd.choice(["\n", "\n\n", "\n \n", " "]).join(rnd.choice([line(), line().upper(), rnd.choice(common)]) for _ in range(rnd.randint(1, 9)))) for i in range(200)]
    rnd.shuffle(rows)
    return rows + [(300, None), (301, ""), (302, "\n\n"), (None, rows[0][1]), (500, "same line in a row here\n" * 50), (501, "w " * 5000), (501, "w " * 5000)]


@pytest.mark.parametrize("least", [1, 20, 60])
def test_equals_brute_force(spark, least):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, row int, digest string")
    for parts in (1, 4):
        d = docs.coalesce(1) if parts == 1 else docs.repartition(4)
        got = sorted((tuple(r) for r in report(d, least).collect()), key=repr)
        assert got == sorted(brute(rows, least), key=repr)


def test_units_tile_the_text():
    assert units("One. Two!? 3.5 three\n\nfour") == [5, 11, 21, 22, 26]
    assert units("第一句。第二句！") == [4, 8] and units("") == [] and units("\n") == [1]
    for _, t in corpus():
        assert "".join((t or "")[s:e] for s, e in pieces(t or "")) == (t or "")


def test_long_passage_goes_and_short_formula_stays(spark):
    passage = " ".join(f"Sentence {k} of a passage that is told again and again." for k in range(8))
    short = "A short formula. "
    rows = [(1, f"Begin. {passage} End."), (2, f"{short}Other words around it. {passage.upper()}\nIts own tail."), (3, f"{short}Nothing else of it."), (4, passage)]
    docs = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, removed string")
    with pytest.raises(ValueError):
        deduplicated(docs)
    got = {r.doc_id: (r.text, [(s.start, s.end) for s in r.spans]) for r in deduplicated(docs, spans="spans").collect()}
    at = rows[1][1].index(passage.upper())
    assert got == {
        1: (rows[0][1], []), 2: (f"{short}Other words around it. Its own tail.", [(at, at + len(passage) + 1)]),
        3: (rows[2][1], []), 4: ("", [(0, len(passage))]),
    }
    assert deduplicated(docs, spans="spans").columns == ["doc_id", "text", "removed", "spans"]


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert report(none).count() == 0 and deduplicated(none).count() == 0
