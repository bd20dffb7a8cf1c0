import random

import numpy as np
import pytest

from wattloom.llm.decontaminate import ERRORS, HIGHEST, Index, SHORTEST, contaminated, edit_band, normal, regions_of, without_leaks


def best_edits(pattern, text):
    """Fewest edits between the pattern and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def budget(m):
    return int(ERRORS * m) if m >= SHORTEST else 0


def clean(t):
    return normal(np.frombuffer((t or "").encode(), np.uint8))[0].tobytes()


def noisy(rnd, t, edits):
    t = list(t)
    for _ in range(edits):
        if not t:
            break
        i = rnd.randrange(len(t))
        how = rnd.randrange(3)
        if how == 0:
            t[i] = rnd.choice("abcdé")
        elif how == 1:
            del t[i]
        else:
            t.insert(i, rnd.choice("xyz"))
    return "".join(t)


@pytest.mark.parametrize("seed", range(4))
def test_finds_what_brute_force_finds(seed):
    rnd = random.Random(seed)
    say = lambda n: " ".join("".join(rnd.choice("aeinst") for _ in range(rnd.randint(1, 7))) for _ in range(n))
    items = [(i, say(rnd.choice([1, 2, 6, 12, 30]))) for i in range(8)] + [(8, None), (9, ""), (10, "Été à  LA\tmer, encore une fois")]
    docs = []
    for _ in range(40):
        body = [say(rnd.randint(0, 30))]
        for _ in range(rnd.choice([0, 1, 1, 2])):
            t = rnd.choice(items[:8])[1]
            body += [noisy(rnd, t, rnd.randint(0, budget(len(t)) + 2)).replace(" ", "  ", 1), say(rnd.randint(0, 10))]
        docs.append(rnd.choice(["", " ", "\n "]) + " ".join(body).upper())
    docs += [None, "", " \n", items[10][1], "x" + items[10][1].upper() + "y"]
    index = Index(items)
    for n, found in regions_of(docs, index, size=2000):
        want = {i for i, t in items if clean(t) and best_edits(clean(t), clean(docs[n])) <= budget(len(clean(t)))}
        assert {f[0] for f in found} == want
        for i, s, e, edits in found:
            assert best_edits(clean(dict(items)[i]), clean(docs[n][s:e])) <= edits <= budget(len(clean(dict(items)[i])))


def test_edit_band():
    p, t = np.frombuffer(b"abcdefgh", np.uint8), np.frombuffer(b"xxabcxdefhyy", np.uint8)
    assert edit_band(p, t, 2, 2, 4) == (2, 2, 10)
    assert edit_band(p, t, 1, 2, 4) is None


def test_tables(spark):
    leak = "what is the capital of the country that lies north of the great river and west of the hills"
    docs = spark.createDataFrame(
        [(1, f"Before. {leak.upper()} after", "en"), (2, "clean", "en"), (2, "clean", "en"), (None, leak, "en"), (3, None, None), (4, "", "x")],
        "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(7, leak), (None, None), (8, "")], "item_id long, text string")
    got = {(r.doc_id, r.n_spans, r.spans) for r in contaminated(docs, items).collect()}
    assert got == {(1, 1, f"7:8:{8 + len(leak)}"), (2, 0, ""), (None, 1, f"7:0:{len(leak)}"), (3, 0, ""), (4, 0, "")}
    left = without_leaks(docs, items)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [2, 2, 3, 4]
    assert without_leaks(docs, items.limit(0)).count() == 6
    assert contaminated(docs.limit(0), items).count() == 0


@pytest.mark.parametrize("size", [24, 25, 95, 233, 394])
@pytest.mark.parametrize("rate", [ERRORS, 0.095])
def test_whole_documented_rate(size, rate):
    rnd = random.Random(size)
    say = lambda n: "".join(rnd.choice("abcdefghijklmnopqrst") for _ in range(n))
    item, most = say(size), int(rate * size)
    docs, want = [], []
    for edits in (0, most - 1, most, most + 1, most + 2):
        for how in range(3):
            t = list(item)
            # Spread evenly, so that as few q-grams as can be stay whole.
            for j in sorted((int((n + 0.5) * size / max(1, edits)) for n in range(edits)), reverse=True):
                t[j : j + 1] = [["Z"], [], ["Z", t[j]]][how]
            docs.append(f"{say(40)} {''.join(t)} {say(40)}")
            want.append(best_edits(clean(item), clean(docs[-1])))
    assert most in want and most + 1 in want
    for n, found in regions_of(docs, Index([(0, item)], rate)):
        assert [f[3] for f in found] == [want[n]] * (want[n] <= most), (n, want[n])


def test_rates_beyond_the_bound_are_refused(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    items = docs.withColumnRenamed("doc_id", "item_id")
    for rate in (HIGHEST, -0.01):
        for call in (lambda: Index([], rate), lambda: contaminated(docs, items, rate), lambda: without_leaks(docs, items, rate)):  # noqa: B023
            with pytest.raises(ValueError, match="q-gram bound"):
                call()
