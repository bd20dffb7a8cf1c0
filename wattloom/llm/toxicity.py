"""Toxicity by a weighted finite-state pattern grammar over clauses.

Three machines are composed. The lexical transducer (an Aho-Corasick automaton of words and word beginnings) rewrites
text to the classes insult and threat. The left machine reads a clause from its beginning and remembers, for a few words
each, that a target or a negation went by, and for the whole clause that speech is reported; the right machine reads it
backwards and remembers a target behind. Their product has one state per combination, tables for the next state and,
for insults and threats, the kind of match put out. Clauses without an insult or threat are never read.

``fit`` learns the insults from labels: of all words and word beginnings of toxic documents it takes, again and again, the one
found in most toxic documents that lack lexemes yet, and in hardly any others. The weights of the match kinds are a
logistic regression. Counting, candidate search and scoring run in Spark; the driver sees bounded lists.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import product

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.base import query, stored, table

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
SEEDS = {
    INSULT: "idiot moron stupid scum loser trash pathetic worthless disgusting clown",
    THREAT: "kill hurt destroy smash töten tuer matar",
    TARGET: "you your u he she they them people du ihr sie euch tu vous ton votre tú usted ustedes vosotros",
    NEGATION: "not no never isn't aren't wasn't don't nicht kein keine nie pas jamais nunca ni",
    REPORT: "said says told called wrote quoted reported claimed sagte schrieb dit écrit dijo escribió",
}
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
CLAUSE = re.compile(r"[.!?;:\n]")
PREFIXES = (4, 5, 6, 7)
DEPTH = 3  # learned lexemes sought in each toxic document
LOOSE = 0.6  # share of toxic documents among those with a lexeme, at least
MEMORY = {TARGET: 4, NEGATION: 3}  # words
POSITIVES, NEGATIVES = 4_000, 12_000  # bounds of the labelled sample


def window(cls: int, k: int):
    """Machine that counts down ``k`` words from the last word of a class; true while it has not ended."""
    return k + 1, lambda s, c: k if c == cls else max(0, s - 1), lambda s: s > 0


def latch(cls: int):
    return 2, lambda s, c: 1 if c == cls else s, lambda s: s > 0


def compose(*machines) -> tuple[np.ndarray, np.ndarray]:
    """Product machine: next state by state and class, and the flags (as bits) that a state stands for."""
    states = list(product(*[range(n) for n, _, _ in machines]))
    number = {s: i for i, s in enumerate(states)}
    step = [[number[tuple(f(x, c) for x, (_, f, _) in zip(s, machines, strict=True))] for c in range(6)] for s in states]
    flags = [sum(bool(g(x)) << i for i, (x, (_, _, g)) in enumerate(zip(s, machines, strict=True))) for s in states]
    return np.array(step), np.array(flags)


LEFT = compose(window(TARGET, MEMORY[TARGET]), window(NEGATION, MEMORY[NEGATION]), latch(REPORT))
RIGHT = compose(window(TARGET, MEMORY[TARGET]))
KINDS = 16  # insult or threat x targeted x negated x reported


@dataclass
class Grammar:
    """Lexemes are words, or word beginnings marked with a final ``*``, with their weight."""

    insults: dict[str, float] = field(default_factory=lambda: {w: 1.0 for w in SEEDS[INSULT].split()})
    coefficients: list[float] | None = None

    def __post_init__(self):
        self.classes = {w: c for c in (THREAT, TARGET, NEGATION, REPORT) for w in SEEDS[c].split()}
        self.left, self.right = LEFT[0].tolist(), RIGHT[0].tolist()
        self.lexical = ahocorasick.Automaton()
        for w in SEEDS[THREAT].split():
            self.lexical.add_word(w, (w, False, THREAT, 1.0))
        for w, weight in self.insults.items():
            self.lexical.add_word(w.rstrip("*"), (w.rstrip("*"), w.endswith("*"), INSULT, weight))
        self.lexical.make_automaton()

    def __getstate__(self):
        return self.insults, self.coefficients

    def __setstate__(self, state):
        self.insults, self.coefficients = state
        self.__post_init__()

    def matches(self, text: str) -> list[tuple[int, int, int, float]]:
        """Start, end, kind and weight of each match of a lower-cased text."""
        hits: dict[int, tuple[int, float]] = {}
        for last, (w, open_, cls, weight) in self.lexical.iter(text):
            a, b = last - len(w) + 1, last + 1
            if (a == 0 or not text[a - 1].isalpha()) and (open_ or b == len(text) or not text[b].isalpha()):
                if a not in hits or hits[a][1] < weight:
                    hits[a] = (cls, weight)
        out, end, words = [], -1, []
        for a in sorted(hits):
            if a >= end:
                before = max(text.rfind(c, 0, a) for c in ".!?;:\n")
                after = CLAUSE.search(text, a)
                end = after.start() if after else len(text)
                words = [(m.start(), m.end(), hits[m.start()][0] if m.start() in hits else self.classes.get(m[0], OTHER)) for m in WORD.finditer(text, before + 1, end)]
                out += self._clause(words, hits)
        return out

    def _clause(self, words, hits):
        ahead, s = [0] * len(words), 0
        for i in range(len(words) - 1, -1, -1):
            ahead[i] = int(RIGHT[1][s])
            s = self.right[s][words[i][2]]
        s, out = 0, []
        for i, (a, b, c) in enumerate(words):
            if a in hits:
                flags = int(LEFT[1][s])
                out.append((a, b, (c == THREAT) << 3 | (flags | ahead[i]) & 7, hits[a][1]))
            s = self.left[s][c]
        return out

    def features(self, text: str | None) -> np.ndarray:
        x = np.zeros(2 * KINDS + 1)
        for _, _, kind, weight in self.matches((text or "").lower()):
            x[kind] += weight
            x[KINDS + kind] = 1
            x[-1] = max(x[-1], weight)
        x[:KINDS] = np.log1p(x[:KINDS])
        return x

    def score(self, text: str | None) -> float:
        z = self.coefficients[0] + float(self.features(text) @ np.array(self.coefficients[1:]))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def words_of(text: str | None) -> set[str]:
    """Words and word beginnings of a text."""
    words = set(WORD.findall((text or "").lower()))
    return words | {w[:k] + "*" for w in words for k in PREFIXES if len(w) > k}


def covering(docs: list[set[str]], support: int, depth: int) -> list[str]:
    """Words, greedily, until each document has ``depth`` of them or what is left is too rare: a word must be the first of ``support``
    documents, or be found in a fiftieth of all."""
    docs, need, out = [set(ws) for ws in docs], [depth] * len(docs), []
    while any(docs):
        gain = Counter(w for ws, k in zip(docs, need, strict=True) if k > 0 for w in ws)
        # Whole words before beginnings, long ones before short ones, where they are found as often.
        w, c = max(gain.items(), key=lambda x: (x[1], not x[0].endswith("*"), len(x[0]), x[0]), default=("", 0))
        if c < support:
            break
        fresh = sum(k == depth and w in ws for ws, k in zip(docs, need, strict=True))
        if fresh < support and c < 0.02 * len(docs):
            docs = [ws - {w} for ws in docs]
            continue
        out.append(w)
        need = [k - (w in ws) for ws, k in zip(docs, need, strict=True)]
        docs = [{x for x in ws if x != w and not (w.endswith("*") and x.startswith(w[:-1]))} for ws in docs]
    return out


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weighted logistic regression with an intercept, by Newton's method."""
    x = np.c_[np.ones(len(x)), x]
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (w * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty), x.T @ (w * (y - p)) - penalty * beta)
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    return beta


def labelled(docs: DataFrame, labels: DataFrame, label: str, positives: int, negatives: int) -> tuple[DataFrame, dict[int, int]]:
    """Texts (``text``, ``y``) of a bounded sample of labelled rows, first by hash of the id, and the number of labels of each kind.

    An id labelled twice counts as positive if any label is; an id with several documents gives one of them.
    """
    marks = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(label).cast("int").alias("y"))
    marks = stored(marks, "marks")
    totals = {r.y: r["count"] for r in marks.groupBy("y").count().collect()}
    first = [marks.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(n) for y, n in ((1, positives), (0, negatives))]
    chosen = stored(first[0].union(first[1]), "chosen")
    # The chosen ids are at most ``positives + negatives`` rows.
    hit = docs.select(F.col("doc_id").alias("d"), "text").join(F.broadcast(chosen), F.col("d") == F.col("id"))
    return stored(hit.dropDuplicates(["id"]).select("id", "text", "y"), "labelled"), totals


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, support: int = 5, precision: float = 0.95) -> Grammar:
    """Grammar learned from ``labels`` (``doc_id``, ``toxic``) and their documents; the seeds alone where there are none."""
    sample, totals = labelled(docs, labels, "toxic", positives, negatives)

    def counts(parts):
        both = Counter(), Counter()
        for pdf in parts:
            for t, y in zip(pdf.text, pdf.y, strict=True):
                both[y].update(words_of(t))
        words = list(both[0].keys() | both[1].keys())
        if words:
            yield pd.DataFrame({"w": words} | {k: np.array([c[w] for w in words], np.int64) for k, c in zip(("outside", "inside"), both, strict=True)})

    n = {y: c for y, c in ((r.y, r["count"]) for r in sample.groupBy("y").count().collect())}
    scale = {y: totals.get(y, 0) / n[y] if n.get(y) else 0.0 for y in (0, 1)}
    found = sample.select("text", "y").mapInPandas(counts, "w string, outside long, inside long").groupBy("w").agg(F.sum("outside").alias("outside"), F.sum("inside").alias("inside"))
    part = F.col("inside") * scale[1]
    found = found.filter(F.col("inside") >= support).withColumn("share", F.try_divide(part, part + F.col("outside") * scale[0]))
    # Every word that toxic texts hold often enough is judged by its share; only those with a high one (and the seeds) are collected.
    rows = found.filter((F.col("share") >= LOOSE) | F.col("w").isin(SEEDS[INSULT].split())).orderBy(F.desc("inside"), "w").collect()
    inside, outside = {r.w: r.inside for r in rows}, {r.w: r.outside for r in rows if r.outside}
    share = {r.w: r.share for r in rows if r.share is not None}
    good = {w for w, p in share.items() if p >= LOOSE}

    def explained(parts):
        for pdf in parts:
            yield pd.DataFrame({"ws": [sorted(words_of(t) & good) for t in pdf.text[pdf.y == 1]]})

    open_ = [set(r.ws) for r in sample.select("text", "y").mapInPandas(explained, "ws array<string>").collect()] if good else []
    chosen = covering([{w for w in ws if share[w] >= precision} for ws in open_], support, DEPTH)
    # Documents without any clear lexeme may have one that clean text holds now and then.
    bare = [ws for ws in open_ if not ws & set(chosen)]
    chosen += covering(bare, support, 1)
    lexemes = {w: math.log((inside[w] + 0.5) / (n.get(1, 0) + 1)) - math.log((outside.get(w, 0) + 0.5) / (n.get(0, 0) + 1)) for w in chosen}
    grammar = Grammar(lexemes | {w: 1.0 for w in SEEDS[INSULT].split() if w not in lexemes and w not in outside})

    def describe(parts):
        for pdf in parts:
            yield pd.DataFrame({"y": pdf.y.to_numpy(), "x": [grammar.features(t).tolist() for t in pdf.text]})

    rows = sample.select("text", "y").mapInPandas(describe, "y int, x array<double>").collect()
    if len({r.y for r in rows}) < 2:
        grammar.coefficients = [-3.0, *[2.0] * KINDS, *[1.0] * KINDS, 0.0]
        return grammar
    x, y = np.array([r.x for r in rows]), np.array([r.y for r in rows], float)
    grammar.coefficients = logistic(x, y, np.where(y > 0, scale[1], scale[0])).tolist()
    return grammar


def scored(docs: DataFrame, grammar: Grammar, *keep: str) -> DataFrame:
    """Columns ``keep`` of every row, and ``score``; a NULL text scores like an empty one."""
    def run(parts):
        for pdf in parts:
            if len(pdf):
                yield pdf[list(keep)].assign(score=np.array([grammar.score(t) for t in pdf["__text"]], float))

    rows = docs.select(*keep, F.col("text").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]) + ", score double"
    return rows.mapInPandas(run, schema)


def clause_matches(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """``doc_id``, ``start``, ``end``, ``kind``, ``weight`` of every match (code points of the lower-cased text)."""
    def run(parts):
        for pdf in parts:
            rows = [(d, *m) for d, t in zip(pdf.doc_id, pdf.text, strict=True) for m in grammar.matches(t.lower())]
            if rows:
                yield pd.DataFrame(rows, columns=["doc_id", "start", "end", "kind", "weight"])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInPandas(run, "doc_id long, start int, end int, kind int, weight double")


def crc_mod(m: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(m))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row; labels are learned from ids whose remainder is not 2."""
    grammar = fit(docs, labels.filter(crc_mod(4) != 2))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = scored(rows.withColumn("held_out", F.coalesce(crc_mod(4) == 2, F.lit(False))), grammar, "doc_id", "held_out")
    return out.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Rows of ``docs`` that score below ``threshold``; columns as they were."""
    grammar = fit(docs, labels.filter(crc_mod(4) != 2))

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array([grammar.score(t) < threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


@query("op7_toxicity")
def op7(spark, folder):
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
