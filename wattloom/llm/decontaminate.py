"""Passages of benchmark items in documents, found by the q-gram lemma and verified by banded alignment.

A document region within edit distance ``k`` of an item of length ``m`` shares at least ``m - q + 1 - k q`` of its q-grams,
all on at most ``2 k + 1`` neighbouring diagonals. Every position of a text is hashed (in numpy, for a batch of texts at once) and
looked up among the items' q-grams; hits are counted in overlapping bands of diagonals, each twice as wide as an alignment can
wander; bands that reach the bound are aligned exactly, in a band around them. Both sides are compared
after lower-casing A-Z and joining white space, and spans are mapped back to the text.

The benchmark is a given table of test items; it goes to every task, as indexes of ``MOST`` bytes each. Its size is checked
before: above ``LIMIT`` the call is refused, as such a table does not belong in a task. Cut it and unite the results of the parts.

An item of ``m`` normalised bytes is found with up to ``int(errors * m)`` edits. Rates at which the lemma's bound would be below one
common q-gram for some length are refused, not lowered.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.base import query, table

Q = 8
ERRORS = 0.08  # edits per normalised byte of the item
MOST = 4 << 20  # bytes of benchmark text in one index
LIMIT = 256 << 20  # bytes of benchmark text that a task is given
SHORTEST = 24  # normalised bytes; shorter items are looked up whole
HIGHEST = min((m // Q) / m for m in range(SHORTEST, SHORTEST + Q))  # rates below it leave every length a bound of one or more
_M = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[[9, 10, 11, 12, 13]] = 32


def normal(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """Lower-cased bytes with runs of white space as one space, none at the ends, and where each byte came from (None: its own place)."""
    low = _LOWER[raw]
    blank = low == 32
    if not len(low) or not (blank[0] or blank[-1] or (blank[1:] & blank[:-1]).any()):
        return low, None
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1]
    at = np.flatnonzero(keep)
    at = at[int(blank[at[0]]) if len(at) else 0 :]
    if len(at) and blank[at[-1]]:
        at = at[:-1]
    return low[at], at


def grams(x: np.ndarray) -> np.ndarray:
    """The eight bytes at each position, as a number."""
    if len(x) < Q:
        return np.empty(0, np.uint64)
    return np.ndarray((len(x) - Q + 1,), "<u8", np.ascontiguousarray(x), strides=(1,))


def edit_band(pattern: np.ndarray, region: np.ndarray, k: int, diagonal: int, width: int) -> tuple[int, int, int] | None:
    """Best alignment of the whole ``pattern`` with a part of ``region``: edits, start, end; None above ``k`` edits.

    Only cells within ``width`` of ``diagonal`` (region minus pattern position) are filled.
    """
    m, n = len(pattern), len(region)
    size = 2 * width + 1
    far = k + 1
    offset = np.arange(size) + diagonal - width  # region position at row 0
    cost = np.where((offset >= 0) & (offset <= n), 0, far)
    start = offset.copy()
    idx = np.arange(size)
    for i in range(1, m + 1):
        j = offset + i
        ok = (j >= 1) & (j <= n)
        same = np.zeros(size, bool)
        same[ok] = region[j[ok] - 1] == pattern[i - 1]
        step = np.where(ok, cost + ~same, far)  # pair two characters
        origin = start
        up = np.r_[cost[1:], far] + 1  # leave out a character of the pattern
        up[(j < 0) | (j > n)] = far
        better = up < step
        step, origin = np.where(better, up, step), np.where(better, np.r_[start[1:], 0], origin)
        # Extra characters of the region: cheapest cell to the left plus the distance.
        run = np.minimum.accumulate(step - idx)
        from_ = np.maximum.accumulate(np.where(step - idx == run, idx, 0))
        left = run + idx
        better = (left < step) & (j <= n)
        cost, start = np.where(better, left, step), np.where(better, origin[from_], origin)
        if cost.min() > k:
            return None
    j = offset + m
    cost = np.where((j >= 0) & (j <= n), cost, far)
    best = int(cost.argmin())
    return (int(cost[best]), int(start[best]), int(j[best])) if cost[best] <= k else None


def allowed(errors: float) -> None:
    if not 0 <= errors < HIGHEST:
        raise ValueError(f"{errors} edits per byte: the q-gram bound holds from 0 to below {HIGHEST:.4f}")


class Index:
    """q-grams of the items with their places. Items shorter than ``SHORTEST`` bytes allow no edits."""

    def __init__(self, items: list[tuple[int, str]], errors: float = ERRORS) -> None:
        allowed(errors)
        self.ids, self.text, self.k, self.least = [], [], [], []
        gram, item, place = [], [], []
        for i, t in items:
            x, _ = normal(np.frombuffer((t or "").encode(), np.uint8))
            if not len(x):
                continue
            k = int(errors * len(x)) if len(x) >= SHORTEST else 0
            g = grams(x) if len(x) >= Q else grams(np.r_[x, np.zeros(Q - len(x), np.uint8)])[:1]
            gram.append(g.copy())
            item.append(np.full(len(g), len(self.ids)))
            place.append(np.arange(len(g)))
            self.ids.append(i)
            self.text.append(x)
            self.k.append(k)
            self.least.append(max(1, len(x) - Q + 1 - k * Q))
        self.tiny = [n for n, x in enumerate(self.text) if len(x) < Q]
        g = np.concatenate(gram) if gram else np.empty(0, np.uint64)
        order = np.argsort(g, kind="stable")
        self.gram = g[order]
        self.item, self.place = (np.concatenate(x)[order].astype(np.int64) if gram else np.empty(0, np.int64) for x in (item, place))
        self.bits = max(16, min(24, int(np.log2(len(g) + 1)) + 6))
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[self._slot(g)] = True
        self.size = np.array([len(x) for x in self.text] or [0])
        self.edits, self.bound = np.array(self.k or [0]), np.array(self.least or [1])

    def _slot(self, g: np.ndarray) -> np.ndarray:
        return (g * _M) >> np.uint64(64 - self.bits)

    def hits(self, x: np.ndarray, block: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Position in ``x``, item and place in the item of every common q-gram."""
        g = grams(x)
        maybe = np.concatenate([a + np.flatnonzero(self.seen[self._slot(g[a : a + block])]) for a in range(0, max(1, len(g)), block)])
        lo = np.searchsorted(self.gram, g[maybe])
        hi = np.searchsorted(self.gram, g[maybe], side="right")
        many = hi - lo
        pos = np.repeat(maybe, many)
        at = np.repeat(lo - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())
        return pos, self.item[at], self.place[at]

    def find(self, x: np.ndarray, cuts: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """Text number, item number, start, end, edits of each region of the texts ``x[cuts[i]:cuts[i + 1]]``.

        Regions of one item that overlap are given once, the one of fewest edits.
        """
        out: list[tuple[int, int, int, int, int]] = []
        for n in self.tiny:
            out += self._whole(x, cuts, n)
        if not len(self.gram) or len(x) < Q:
            return out
        pos, item, place = self.hits(x)
        text = np.searchsorted(cuts, pos, side="right") - 1
        fits = pos + Q <= cuts[text + 1]
        # A document and an item with too few common q-grams in all have too few on any diagonals.
        pair = text * len(self.ids) + item
        if (len(cuts) - 1) * len(self.ids) < 20_000_000:
            fits &= np.bincount(pair[fits], minlength=(len(cuts) - 1) * len(self.ids))[pair] >= self.bound[item]
        pos, item, place, text = pos[fits], item[fits], place[fits], text[fits]
        if not len(pos):
            return out
        # An alignment with k edits stays within k diagonals of where it begins, so 2 k + 1 in all: bands
        # of twice that many, half overlapping, hold it whole in one of them.
        half = 2 * self.edits[item] + 1
        band = (pos - place + (1 << 40)) // half
        # Band j holds the diagonals of j and of j + 1: a hit counts in its own and in the one before.
        t, i, d = np.r_[text, text], np.r_[item, item], np.r_[band, band - 1]
        order = np.lexsort((d, i, t))
        t, i, d = t[order], i[order], d[order]
        head = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (i[1:] != i[:-1]) | (d[1:] != d[:-1])])
        total = np.diff(np.r_[head, len(t)])
        good = head[total >= self.bound[i[head]]]
        regions: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        for h in good.tolist():
            n = int(i[h])
            a, b = int(cuts[t[h]]), int(cuts[t[h] + 1])
            k, m = int(self.edits[n]), int(self.size[n])
            base = int(d[h]) * (2 * k + 1) - (1 << 40)  # first diagonal of the band
            lo, hi = max(a, base - k), min(b, base + 2 * (2 * k + 1) + m + k)
            exact = x[lo:hi].tobytes().find(self.text[n].tobytes())
            got = (0, exact, exact + m) if exact >= 0 else edit_band(self.text[n], x[lo:hi], k, base + 2 * k + 1 - lo, 3 * k + 2)
            if got:
                regions.setdefault((int(t[h]), n), []).append((got[0], lo + got[1] - a, lo + got[2] - a))
        for (doc, n), rows in regions.items():
            kept: list[tuple[int, int]] = []
            for edits, s, e in sorted(rows):
                if all(e <= s2 or s >= e2 for s2, e2 in kept):
                    kept.append((s, e))
                    out.append((doc, n, s, e, edits))
        return out

    def _whole(self, x: np.ndarray, cuts: np.ndarray, n: int) -> list[tuple[int, int, int, int, int]]:
        raw, item, out, at = x.tobytes(), self.text[n].tobytes(), [], 0
        while (at := raw.find(item, at)) >= 0:
            t = int(np.searchsorted(cuts, at, side="right")) - 1
            if at + len(item) <= cuts[t + 1]:
                out.append((t, n, at - int(cuts[t]), at + len(item) - int(cuts[t]), 0))
            at += len(item)
        return out


def regions_of(texts: list[str | None], index: Index, size: int = 4 << 20):
    """For each text the list of (item, start, end, edits), positions in code points."""
    done, part, held = 0, [], 0
    for n, t in enumerate(texts):
        part.append((t or "").encode("utf-8", "surrogatepass"))
        held += len(part[-1])
        if held >= size or n == len(texts) - 1:
            made = [normal(np.frombuffer(r, np.uint8)) for r in part]
            cuts = np.r_[0, np.cumsum([len(x) for x, _ in made])].astype(np.int64)
            out: list[list] = [[] for _ in part]
            for doc, item, s, e, edits in index.find(np.concatenate([x for x, _ in made]), cuts):
                if e <= s:
                    continue
                at = made[doc][1]
                first, last = (s, e - 1) if at is None else (int(at[s]), int(at[e - 1]))
                # Code points: bytes that do not continue a character.
                lead = np.cumsum((np.frombuffer(part[doc], np.uint8) & 0xC0) != 0x80)
                out[doc].append((index.ids[item], int(lead[first]) - 1, int(lead[last]), edits))
            for n2 in range(len(part)):
                yield done + n2, sorted(out[n2], key=lambda r: (r[1], r[2], r[0] if r[0] is not None else -1))
            done, part, held = n + 1, [], 0


def indexes(benchmark: DataFrame) -> list[list[tuple[int, str]]]:
    """Items in parts of at most ``MOST`` bytes (a single longer item is a part of its own)."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > LIMIT:
        raise ValueError(f"benchmark of {size} bytes, above {LIMIT}: cut it and unite the results")
    parts, held = [[]], 0
    for r in benchmark.select(F.col("item_id").cast("long").alias("i"), "text").filter(F.length("text") > 0).toLocalIterator():
        if held and held + len(r.text) > MOST:
            parts.append([])
            held = 0
        parts[-1].append((r.i, r.text))
        held += len(r.text)
    return [p for p in parts if p]


def contaminated(docs: DataFrame, benchmark: DataFrame, errors: float = ERRORS) -> DataFrame:
    """``doc_id``, ``n_spans``, ``items`` (ids, sorted), ``edits`` (fewest), ``spans`` (``item:start:end``, by start) of every row."""
    def run(batches):
        index = [Index(p, errors) for p in parts]
        for batch in batches:
            texts = batch.column(1).to_pylist()
            rows: list[list] = [[] for _ in texts]
            for x in index:
                for n, found in regions_of(texts, x):
                    rows[n] += found
            for r in rows:
                r.sort(key=lambda f: (f[1], f[2], -1 if f[0] is None else f[0]))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(r) for r in rows], pa.int64()),
                pa.array([sorted({f[0] for f in r if f[0] is not None}) for r in rows], pa.list_(pa.int64())),
                pa.array([min((f[3] for f in r), default=None) for r in rows], pa.int32()),
                pa.array([",".join(f"{'' if f[0] is None else f[0]}:{f[1]}:{f[2]}" for f in r) for r in rows], pa.string()),
            ], ["doc_id", "n_spans", "items", "edits", "spans"])

    allowed(errors)
    parts = indexes(benchmark)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_spans long, items array<long>, edits int, spans string")


def without_leaks(docs: DataFrame, benchmark: DataFrame, errors: float = ERRORS) -> DataFrame:
    """Rows of ``docs`` whose text holds no benchmark passage; columns as they were."""
    def run(batches):
        index = [Index(p, errors) for p in parts]
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            clean = np.ones(len(texts), bool)
            for x in index:
                for n, found in regions_of(texts, x):
                    clean[n] &= not found
            yield batch.filter(pa.array(clean))

    allowed(errors)
    parts = indexes(benchmark)
    return docs.mapInArrow(run, docs.schema) if parts else docs


@query("op10_benchmark_decontamination")
def op10(spark, folder):
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
