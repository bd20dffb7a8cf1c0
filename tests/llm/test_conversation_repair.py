import hashlib
import itertools
import random
import re
import zlib

import pytest

from wattloom.llm import conversation_repair
from wattloom.llm.conversation_repair import damaged, edits, repaired, report

SPACE = " \t\n\x0b\x0c\r"


def faults(rows):
    """Fault of each row; rows are (turn, role, text) in order."""
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(SPACE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, bad):
    """Least (cost, audit, repaired) over all edits, by whole strings: states of the pattern, rows read so far."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    best = {"": (0, "", ())}

    def inserted(best):
        for _ in range(3):
            for state, (c, a, r) in list(best.items()):
                for token, name in (("u", "user"), ("a", "assistant")):
                    after = step.get((state, token))
                    new = (c + 5, a + "I", (*r, name + ":"))
                    if after and (after not in best or new < best[after]):
                        best[after] = new
        return best

    best = inserted(best)
    for (_, role, text), fault in zip(rows, bad, strict=True):
        new = {}

        def offer(state, value, new=new):
            if state is not None and (state not in new or value < new[state]):
                new[state] = value

        for state, (c, a, r) in best.items():
            offer(state, (c + 2, a + "D", r))
            if fault in ("", "truncated"):
                more = 5 if fault else 0
                offer(step.get((state, role[:1])) if role else None, (c + more, a + "K", (*r, f"{role}:{text}")))
                for token, name in (("u", "user"), ("a", "assistant")):
                    offer(step.get((state, token)), (c + 1 + more, a + "R", (*r, f"{name}:{text}")))
        best = inserted(new)
    return min(best[s] for s in ("", "a") if s in best)


def exhaustive(rows, bad):
    """The same by trying every edit of every row, with up to two insertions in each place."""
    found = []
    choices = [["D"] if f in ("blank", "duplicate") else ["D", "K", "u", "a"] for f in bad]
    inserts = ["", "u", "a", "ua", "au"]
    for picked in itertools.product(*choices):
        for added in itertools.product(inserts, repeat=len(rows) + 1):
            cost, audit, roles, out = 0, "", "", []
            for k in range(len(rows) + 1):
                for t in added[k]:
                    cost, audit, roles = cost + 5, audit + "I", roles + t
                    out.append({"u": "user:", "a": "assistant:"}[t])
                if k < len(rows):
                    (_, role, text), p = rows[k], picked[k]
                    cost += {"D": 2, "K": 0}.get(p, 1) + (5 if bad[k] == "truncated" and p != "D" else 0)
                    audit += p if p in "DK" else "R"
                    if p != "D":
                        name = role if p == "K" else {"u": "user", "a": "assistant"}[p]
                        roles += name[:1] or "?"
                        out.append(f"{name}:{text}")
            if re.fullmatch("(s?(ua)+)?", roles):
                found.append((cost, audit, tuple(out)))
    return min(found)


def plain(conv, rows):
    """Expected report of one conversation; rows are (turn, role, text) after damage."""
    rows = sorted(((t, r or " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
    bad = faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit, out = cheapest(rows, bad)
    return (conv, gaps, *(bad.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def random_rows(rnd, n):
    text = lambda: rnd.choice(["One.", "Two!", "Three? \n", "open", "", " \t", "Long text. " * rnd.randint(1, 3), "四。", "end."])
    role = lambda: rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "User", None])
    return [(rnd.choice([None, *range(12)]) if rnd.random() < 0.3 else k, role(), rnd.choice([text(), f"Turn {k}."]) if rnd.random() < 0.95 else None) for k in range(n)]


def test_plain_rule_equals_exhaustive_search():
    rnd = random.Random(1)
    for _ in range(150):
        rows = [(k, rnd.choice(["user", "assistant", "system", "tool", ""]), rnd.choice(["A.", "B.", "open", ""])) for k in range(rnd.randint(0, 3))]
        assert cheapest(rows, faults(rows)) == exhaustive(rows, faults(rows))


@pytest.mark.parametrize("hold", [1, 64])
def test_report_equals_plain_rule(spark, hold, monkeypatch):
    monkeypatch.setattr(conversation_repair, "HOLD", hold)
    rnd = random.Random(7)
    convs = {c: random_rows(rnd, rnd.choice([1, 2, 3, 5, 8, 20, 60])) for c in range(250)}
    convs[None] = random_rows(rnd, 6)
    convs[1000] = [(k, "user", "Again and again.") for k in range(300)]
    convs[1001] = [(k, "assistant", "") for k in range(200)] + [(500, "user", "Yes.")]
    convs[1002] = [(k, ["user", "assistant"][k % 2], f"Turn {k}.") for k in range(700)]
    convs[1003] = [(k, rnd.choice(["user", "assistant"]), rnd.choice([f"Turn {k}.", f"open {k}", "Again."])) for k in range(900)]
    flat = [(c, *r, 1, "x", 0) for c, rows in convs.items() for r in rows]
    rnd.shuffle(flat)
    df = spark.createDataFrame(flat, "conv_id long, turn long, role string, text string, times int, digest string, fault int").repartition(5)
    got = sorted((tuple(r) for r in report(df).collect()), key=repr)
    assert got == sorted((plain(c, rows) for c, rows in convs.items()), key=repr)
    text = {}
    for r in repaired(df).orderBy("conv_id", "place").collect():
        text.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert {r[0]: r[-1] for r in got} == {c: hashlib.sha256("\n".join(text.get(c, [])).encode()).hexdigest() for c in convs}


def test_alternatives_agree_soon():
    """What a parse holds does not grow with the conversation."""
    rnd = random.Random(5)
    parse, most = conversation_repair.Parse(), 0
    for k in range(20000):
        if rnd.random() < 0.3:
            parse.delete(rnd.randint(1, 1000))
        else:
            parse.read(rnd.choice(["user", "assistant", "assistant", "system"]), f"text {k}", rnd.random() < 0.2)
        most = max(most, len(parse.held))
    assert most <= 2 * conversation_repair.HOLD and len(parse.tops) <= 6


def test_damage(spark):
    rnd = random.Random(3)
    flat = [(c, *r) for c in range(300) for r in random_rows(rnd, rnd.randint(1, 8))] + [(None, 1, "user", "A."), (7, None, None, None)]
    flat += [(c, 0, "user", "Alone.") for c in range(400, 500)]
    want = {}
    for c, t, role, text in flat:
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        own = want.setdefault(c, [])
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        own += [(t, "user" if fate == 4 else role, text)] * {0: 0, 3: 2}.get(fate, 1)
    df = spark.createDataFrame([(*r, 5) for r in flat], "conv_id long, turn long, role string, text string, fate int")
    got = sorted((tuple(r) for r in report(*damaged(df)).collect()), key=repr)
    assert got == sorted((plain(c, rows) for c, rows in want.items()), key=repr)
    assert any(not rows for rows in want.values())


def test_empty_table_and_long_text(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert report(spark.createDataFrame([], schema)).count() == 0 and edits(spark.createDataFrame([], schema)).count() == 0
    long = "word. " * 300_000
    rows = [(0, "user", long), (1, "assistant", "Yes.")]
    got = report(spark.createDataFrame([(1, *r) for r in rows], schema)).collect()
    assert [tuple(r) for r in got] == [plain(1, rows)]
