"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages of ``WORDS`` words. Every passage is encoded (kinds of characters, shapes and repetition of words), a
layer turns the code into a hidden vector, gated attention weighs the passages (tanh and sigmoid branches, softmax over the
bag), and the weighted passage is scored. Labels are of documents only; which passages matter is learned with the rest.

The model is fitted on a bounded sample of labelled documents (``POSITIVES``, ``NEGATIVES``); scoring reads every
passage of every text. Codes of many texts are computed together, with numpy inside Spark tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.base import query, table
from wattloom.llm.shingles import text_groups, word_hashes
from wattloom.llm.toxicity import crc_mod, labelled

WORDS = 64
POSITIVES, NEGATIVES = 6_000, 6_000
BAG = 64  # passages of a document while fitting; more are averaged in runs. Scoring uses all.
HIDDEN, GATE = 24, 16

_PUNCT = [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]
_KIND = np.zeros(256, np.int64)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[32], _KIND[10], _KIND[128:192], _KIND[192:] = 1, 2, 3, 4, 5, 6, 7
_KIND[_PUNCT] = np.arange(8, 8 + len(_PUNCT))
KINDS = 8 + len(_PUNCT)
DIM = KINDS + 8


def encode(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all passages (rows), and the number of passages of each text; at least one, of zeros for a text without words."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw])
    buf = b"\n".join(raw) + b"\n"
    start, end, h = word_hashes(buf.lower())
    doc = np.searchsorted(ends, start, side="right")
    words = np.bincount(doc, minlength=len(raw))
    bags = np.maximum(1, -(-words // WORDS))
    first = np.r_[0, np.cumsum(bags)[:-1]]
    x = np.zeros((int(bags.sum()), DIM), np.float32)
    if not len(start):
        return x, bags
    nth = np.arange(len(start)) - np.r_[0, np.cumsum(words)[:-1]][doc]
    passage = first[doc] + nth // WORDS
    # A passage runs from its first word to the next passage's, or to the end of its text.
    begin = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
    at = start[begin]
    stop = np.minimum(np.r_[at[1:], len(buf)], ends[doc[begin]] - 1)
    mine = passage[begin]
    size = np.maximum(1, stop - at)
    data = np.frombuffer(buf, np.uint8)
    for a in range(0, len(begin), 4096):
        b = min(a + 4096, len(begin))
        lo, hi = int(at[a]), int(stop[b - 1])
        edge = np.repeat(np.arange(b - a), np.diff(np.r_[at[a:b], hi]))
        inside = np.arange(lo, hi) < stop[a:b][edge]  # not what lies between two texts
        counts = np.bincount((edge * KINDS + _KIND[data[lo:hi]])[inside], minlength=(b - a) * KINDS).reshape(-1, KINDS)
        x[mine[a:b], :KINDS] = np.log1p(100.0 * counts / size[a:b, None])
    n = np.diff(np.r_[begin, len(start)])
    same = np.r_[False, (h[1:] == h[:-1]) & (passage[1:] == passage[:-1])]
    order = np.lexsort((h, passage))
    fresh = np.r_[True, (h[order][1:] != h[order][:-1]) | (passage[order][1:] != passage[order][:-1])]
    length = (end - start).clip(0, 200)
    total = lambda v: np.add.reduceat(v.astype(np.float64), begin)
    mean = total(length) / n
    lead = data[start]
    x[mine, KINDS:] = np.stack([
        np.log1p(n), total(same) / n, total(fresh)[np.arange(len(begin))] / n, mean / 10, np.sqrt(np.maximum(0, total(length**2) / n - mean**2)) / 10,
        total((lead >= 65) & (lead <= 90)) / n, total(length <= 3) / n, total(length > 15) / n], axis=1)
    return x, bags


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w: dict[str, np.ndarray]

    def attend(self, x: np.ndarray, bags: np.ndarray):
        """Scores of the bags, and the weight of each passage in its bag."""
        w, at = self.w, np.r_[0, np.cumsum(bags)[:-1]]
        x = (x - self.mean) / self.scale
        h = np.maximum(0, x @ w["h"] + w["hb"])
        t, g = np.tanh(h @ w["v"] + w["vb"]), 1 / (1 + np.exp(-np.clip(h @ w["u"] + w["ub"], -30, 30)))
        e = (t * g) @ w["a"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, at), bags))
        a = e / np.repeat(np.add.reduceat(e, at), bags)
        z = np.add.reduceat(h * a[:, None], at)
        s = z @ w["c"] + w["cb"]
        return 1 / (1 + np.exp(-np.clip(s, -30, 30))), a, (x, h, t, g, z)


def train(x: np.ndarray, bags: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int = 40, rate: float = 0.01, decay: float = 1e-4) -> Model:
    """Adam on the weighted cross-entropy; gradients of attention and layers are written out. Order and start come from a fixed seed."""
    rng = np.random.default_rng(0)
    init = lambda *s: rng.standard_normal(s) / np.sqrt(s[0])
    w = {"h": init(DIM, HIDDEN), "hb": np.zeros(HIDDEN), "v": init(HIDDEN, GATE), "vb": np.zeros(GATE), "u": init(HIDDEN, GATE), "ub": np.zeros(GATE), "a": init(GATE), "c": init(HIDDEN), "cb": np.zeros(())}
    model = Model(x.mean(0), x.std(0) + 1e-3, w)
    first = np.r_[0, np.cumsum(bags)]
    m, v, step = {k: np.zeros_like(p) for k, p in w.items()}, {k: np.zeros_like(p) for k, p in w.items()}, 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for b in range(0, len(order), 256):
            part = order[b : b + 256]
            rows = np.concatenate([np.arange(first[i], first[i + 1]) for i in part])
            n = bags[part]
            p, a, (xs, h, t, g, z) = model.attend(x[rows], n)
            at = np.r_[0, np.cumsum(n)[:-1]]
            d = (p - y[part]) * weight[part] / weight[part].sum()
            dz = np.repeat(d[:, None] * w["c"], n, axis=0)
            da = (dz * h).sum(1)
            de = a * (da - np.repeat(np.add.reduceat(a * da, at), n))
            dt, dg = de[:, None] * w["a"] * g * (1 - t**2), de[:, None] * w["a"] * t * g * (1 - g)
            dh = (dz * a[:, None] + dt @ w["v"].T + dg @ w["u"].T) * (h > 0)
            grad = {"c": d @ z, "cb": d.sum(), "a": (t * g).T @ de, "v": h.T @ dt, "vb": dt.sum(0), "u": h.T @ dg, "ub": dg.sum(0), "h": xs.T @ dh, "hb": dh.sum(0)}
            step += 1
            for k, q in grad.items():
                q = q + decay * w[k]
                m[k] = 0.9 * m[k] + 0.1 * q
                v[k] = 0.999 * v[k] + 0.001 * q * q
                w[k] = w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return model


def pooled(x: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` rows, each the mean of a run of rows."""
    if len(x) <= most:
        return x
    at = np.linspace(0, len(x), most, endpoint=False).astype(int)
    return np.add.reduceat(x, at) / np.diff(np.r_[at, len(x)])[:, None]


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES) -> Model:
    """Model learned from ``labels`` (``doc_id``, ``quality``); without both kinds of labels one that gives their share, or one half."""
    sample, totals = labelled(docs, labels, "quality", positives, negatives)

    def codes(batches):
        for (y,), texts in text_groups(batches):
            x, bags = encode(texts)
            cut = np.r_[0, np.cumsum(bags)]
            yield pa.RecordBatch.from_arrays([y, pa.array([pooled(x[a:b], BAG).astype("<f4").tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())], ["y", "x"])

    rows = sorted((bytes(r.x), r.y) for r in sample.select("text", "y").mapInArrow(codes, "y int, x binary").collect())
    y = np.array([r[1] for r in rows], float)
    if len(set(y.tolist())) < 2:
        share = (y.mean() if len(y) else 0.5).clip(0.02, 0.98) if len(y) else 0.5
        flat = train(np.zeros((2, DIM)), np.array([1, 1]), np.array([0.0, 1.0]), np.ones(2), epochs=0)
        flat.w["c"][:], flat.w["cb"] = 0, np.log(share / (1 - share))
        return flat
    parts = [np.frombuffer(r[0], "<f4").reshape(-1, DIM) for r in rows]
    count = {k: (y == k).sum() for k in (0, 1)}
    weight = np.where(y == 1, totals[1] / count[1], totals[0] / count[0])
    return train(np.concatenate(parts).astype(np.float64), np.array([len(p) for p in parts]), y, weight)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` and ``n_passages`` of every row; labels are learned from ids whose remainder is not 1.

    A NULL text is an empty one, a bag of one empty passage. Rows that repeat are scored each.
    """
    model = fit(docs, labels.filter(crc_mod(3) != 1))

    def score(batches):
        for (doc, held), texts in text_groups(batches):
            x, bags = encode(texts)
            p = model.attend(x, bags)[0]
            yield pa.RecordBatch.from_arrays([doc, held, pa.array(p), pa.array((p >= threshold).astype(np.int32)), pa.array(bags.astype(np.int64))], ["doc_id", "held_out", "score", "predicted", "n_passages"])

    rows = docs.select("text", F.col("doc_id").cast("long").alias("doc_id")).withColumn("held_out", F.coalesce(crc_mod(3) == 1, F.lit(False)))
    return rows.select("text", "doc_id", "held_out").mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int, n_passages long")


def attention(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``passage`` (from 0), ``weight``: how much each passage counts in its document."""
    def weigh(batches):
        for (doc,), texts in text_groups(batches):
            x, bags = encode(texts)
            a = model.attend(x, bags)[1]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(doc.to_pylist(), object), bags).tolist(), pa.int64()), pa.array(np.concatenate([np.arange(n) for n in bags]).astype(np.int32)), pa.array(a)], ["doc_id", "passage", "weight"])

    return docs.select("text", F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(weigh, "doc_id long, passage int, weight double")


@query("op9_quality_classifier")
def op9(spark, folder):
    return quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
