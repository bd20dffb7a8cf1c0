import hashlib
import random
import re
import time

from wattloom.llm.secrets import SCOPE, redacted, secrets

FIXED = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, None),
    ("access", r"AKIA[A-Z0-9]+", 0, 16, None), ("hex", r"[0-9a-f]+", 0, 32, None),
    ("endpoint", r"""(?:https?|ftp|ssh|postgres|mysql|redis|amqp|mongodb)://[^\x20\x09-\x0D"'<>]+""", 0, 1, None),
    ("account", r"""(?i:(user(?:name)?|login|account|client_?id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@=-]+)""", 2, 3, None),
    ("key", r"[A-Za-z0-9/+]+", 0, 40, 40),
]
ORDER = [k for k, *_ in FIXED]


def brute(text):
    spans = [(m.start(), ORDER.index(k), m.end(), k) for k, p, g, least, most in FIXED for m in re.finditer(p, text or "", re.ASCII)
             if len(m[g]) >= least and (most is None or len(m[g]) <= most)]
    base = [s for s in spans if s[1] < 3]
    need = {"endpoint": [{"access", "account"}, {"assign", "hex", "key"}], "account": [{"assign", "hex", "key"}, {"endpoint"}], "key": [{"access", "account"}]}
    extra = []
    for s in spans:
        if s[3] in need:
            near = {o[3] for o in spans if o[0] <= s[2] + SCOPE and o[2] >= s[0] - SCOPE and (o[0] >= s[2] or o[2] <= s[0])}
            if all(near & g for g in need[s[3]]):
                extra.append(s)
    show = lambda x: ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(x))
    n = [sum(s[3] == k for s in base) for k in ORDER[:3]]
    return (*n, hashlib.sha256(show(base).encode()).hexdigest(), show(base + extra))


def texts():
    rnd = random.Random(5)
    bits = ["password: hunter2hunter2", "token=short", 'API_KEY = "abc.def-ghi="', "token=secret: abcdefghij", "AKIA" + "Q7" * 8, "AKIAAKIA12", "deadbeef" * 4, "deadbeef" * 3,
            "https://api.example.com/v1", "user=bob@x.org", "login: al", "A1b2/" * 8, "A1b2/" * 9, "postgres://u:p@h:5432/db", "plain words here.", "é 🙂 ü", "\n", "x" * 180, "secretly", "apikey='ZZZZZZZZ'", "ſecret=abcdefgh1"]
    return [" ".join(rnd.choice(bits) for _ in range(rnd.randint(1, 14))) for _ in range(300)] + [None, "", "AKIA", "token=", "🙂" * 300 + "token=abcdefgh", "api_key=" + "q" * 100000]


def test_equals_brute_force(spark):
    rows = list(enumerate(texts())) + [(None, "token=abcdefgh"), (3, "again"), (3, "again")]
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, kind string, row int").repartition(4)
    got = sorted((tuple(r) for r in secrets(docs).collect()), key=repr)
    assert got == sorted(((d, *brute(t)) for d, t in rows), key=repr)
    plan = secrets(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_redaction(spark):
    rows = [(1, "a token=abcdefgh1 b", 1), (2, "clean", 5), (3, None, None), (4, "see https://x.org user=bob token: 12345678 end", 9), (5, "see https://x.org end", 21), (6, "k=" + "deadbeef" * 4 + " token=" + "deadbeef" * 4, 0)]
    docs = spark.createDataFrame([(*r, "z", "e", 1, "b") for r in rows], "doc_id long, text string, n_chars long, start string, extra string, row int, base string")
    out = redacted(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert got == {1: ("a [ASSIGN] b", 12), 2: ("clean", 5), 3: (None, None), 4: ("see [ENDPOINT] [ACCOUNT] [ASSIGN] end", 37), 5: ("see https://x.org end", 21), 6: ("k=[HEX] [ASSIGN]", 16)}


def test_many_matches_in_one_text(spark):
    """Blocks of matches join without a seam; 32,000 matches in a megabyte stay within a minute."""
    rnd = random.Random(7)
    hexes = lambda n: ["%032x" % rnd.getrandbits(128) for _ in range(n)]
    mixed = [rnd.choice(["é", "token=" + "%032x" % rnd.getrandbits(128), "user=bob", "AKIA" + "Q7" * 8, "%040x" % rnd.getrandbits(160), "https://x.org/é", "word"]) for _ in range(1500)]
    texts = [" ".join(mixed), " ".join(hexes(129)), " ".join(hexes(128)), " 🙂 ".join(hexes(32_000))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    begun = time.monotonic()
    rows, out = sorted(tuple(r) for r in secrets(docs).collect()), {r.doc_id: r.text for r in redacted(docs).collect()}
    assert time.monotonic() - begun < 60
    for (d, *got), text in zip(rows, texts, strict=True):
        assert tuple(got) == brute(text)
        done, at = [], 0
        for kind, a, b in sorted((x.split(":") for x in got[-1].split(",")), key=lambda x: (int(x[1]), ORDER.index(x[0]))):
            if int(a) >= at:
                done += [text[at : int(a)], f"[{kind.upper()}]"]
            at = max(at, int(b))
        assert out[d] == "".join(done) + text[at:]


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert secrets(none).count() == 0 and redacted(none).count() == 0
