"""Best-fit packing of token pieces by bin completion with branch and bound.

Sequences hold whole lengths up to a fixed capacity, so the packing problem is the histogram of the
lengths: at most ``capacity`` numbers, whatever the number of documents. The driver solves that (``complete``), which gives
patterns with multiplicities; every piece then finds its place by its rank among the pieces of its length, which Spark counts
in salted groups. No piece passes through the driver.

Bin completion: take the largest length left, list the fillings of the space that it leaves, largest first, and drop those
that another filling dominates (the same space or more, used by larger pieces). A plain best-fit filling is the incumbent;
a branch whose waste bound cannot beat it is cut. The chosen pattern is used as often as the counts allow. What comes out is a whole packing, the
incumbent. While it has more sequences than the token count asks for, its last sequences, of which pieces fit worst, are packed again into one fewer
(``fewer``): branches over all undominated fillings of the largest piece left, cut where the waste of all sequences together exceeds what is to spare. A packing of
up to ``WINDOW`` sequences is searched as a whole, so its result is optimal unless ``search`` nodes end the search.
"""

from __future__ import annotations

import bisect
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.base import query, stored, table

CAPACITY = 2048
CACHE = 1_000_000  # words per worker
WINDOW = 32  # sequences packed again at once
# White space besides single spaces and line feeds between words.
ODD = [" " * 2, " \n", "\n ", "\n" * 2, *map(chr, [1, 9, 11, 12, 13, 28, 29, 30, 31, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])]
# Units of the pattern in ASCII words; apostrophes, special tokens and white space inside are left to the whole encoder.
UNITS = re.compile(r" ?[A-Za-z]+| ?[0-9]+| ?[^ A-Za-z0-9]+")
WHOLE = re.compile(r"'|<\||.[\x00-\x20\x7F]|^[\x00-\x1F\x7F]| $", re.S)
# How byte-level vocabularies write bytes: printable ones as they are, the others from 256 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTES = {b: b if b in _SHOWN else 256 + sum(c not in _SHOWN for c in range(b)) for b in range(256)}


class Encoder:
    """Token ids of texts as packed little-endian numbers, from a ``tokenizers`` file.

    The byte-level pattern never joins characters over a single space (or line feed) between two other characters. Texts are
    cut there and the cuts are looked up. Of new ones, plain words are units of the pattern, or a few (letters, digits, signs), and go to the
    vocabulary's model directly; all others are encoded whole. Any other white space stays inside its cut.
    """

    def __init__(self, file: str) -> None:
        from tokenizers import Tokenizer

        self.model, self.known = Tokenizer.from_file(file), {}
        self.merge = self.model.model.tokenize

    def cuts(self, text: str) -> list[str]:
        if not text:
            return []
        if text[0] not in " \n" and text[-1] not in " \n" and not any(o in text for o in ODD):
            return text.replace(" ", "\1 ").replace("\n", "\1\n\1").split("\1")
        out = []
        for i, part in enumerate(re.split(r"(?<=\S) (?=\S)", text)):
            whole = re.split(r"(?<=\S)(\n)(?=\S)", part)
            whole[0] = (" " if i else "") + whole[0]
            out += whole
        return out

    def unit(self, word: str) -> bytes:
        """Ids of one unit of the pattern: letters, digits or other signs, with or without a space in front."""
        ids = self.known.get(word)
        if ids is None:
            shown = word.translate(BYTES) if word.isascii() else word.encode().decode("latin-1").translate(BYTES)
            ids = self.known[word] = array("I", [t.id for t in self.merge(shown)]).tobytes()
        return ids

    def learn(self, word: str) -> bytes:
        if word.isascii() and not WHOLE.search(word):
            ids = b"".join(map(self.unit, UNITS.findall(word)))
        elif word.removeprefix(" ").isalpha():
            return self.unit(word)
        elif word[-1:] in (".", ",") and word[:-1].removeprefix(" ").isalpha():
            ids = self.unit(word[:-1]) + self.unit(word[-1])
        else:
            ids = array("I", self.model.encode(word, add_special_tokens=False).ids).tobytes()
        self.known[word] = ids
        return ids

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for text in texts:
            cuts = self.cuts(text)
            ids = list(map(self.known.get, cuts))
            if None in ids:
                for i, found in enumerate(ids):
                    if found is None:
                        ids[i] = self.known.get(cuts[i]) or self.learn(cuts[i])
            yield b"".join(ids)
            if len(self.known) > CACHE:
                self.known = {}


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` ids: full ones, and before them what is left over."""
    first = (n - 1) % capacity + 1
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces(docs: DataFrame, file: str | None = None, capacity: int = CAPACITY, end: int = 0, with_ids: bool = False) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` (and ``ids``) of every row; a NULL text is an empty one.

    ``file`` is the tokenizer's path on the executors (None: the public byte-level vocabulary).
    """
    def cut(batches):
        encoder = Encoder(file or tokenizer_file())
        tail = np.array([end], "<u4").tobytes()
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode([t or "" for t in batch.column(1).to_pylist()]), strict=True):
                ids += tail
                for k, (s, n) in enumerate(piece_bounds(len(ids) // 4, capacity)):
                    part = ids[4 * s : 4 * (s + n)]
                    row = (doc, k, s, n, zlib.crc32(part), np.frombuffer(part, "<u4").astype(np.int32) if with_ids else None)
                    for col, x in zip(out, row, strict=True):
                        col.append(x)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)][: 5 + with_ids], names[: 5 + with_ids])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


def filling(space: int, rising: list[int], left: dict[int, int], branch: int) -> tuple[int, ...]:
    """Undominated filling of ``space`` that wastes least, from lengths ``rising`` (each as often as ``left`` has it).

    Branches take the largest length first, so of fillings with equal waste the one of larger pieces is met first and
    the ones it dominates never replace it. The incumbent is the best-fit filling. A branch ends when the space it must
    leave (all smaller lengths together do not fill it) is no less than the incumbent's. ``branch`` bounds the nodes
    of one search, not the pieces packed.
    """
    best, room, used = [], space, {}
    i = bisect.bisect_right(rising, room) - 1
    while i >= 0:
        x = rising[i]
        k = min(left[x], room // x)
        best += [x] * k
        room -= k * x
        i = bisect.bisect_right(rising, room, 0, i) - 1
    waste = room
    if not waste:
        return tuple(best)
    reach = [0]
    for x in rising:
        reach.append(reach[-1] + x * left[x])
    chosen: list[int] = []
    room, i, nodes = space, bisect.bisect_right(rising, space) - 1, 0
    while nodes < branch:
        nodes += 1
        if i >= 0 and room - reach[i + 1] < waste:
            x = rising[i]
            if used.get(x, 0) < left[x]:
                chosen.append(x)
                used[x] = used.get(x, 0) + 1
                room -= x
                if room < waste:
                    waste, best = room, list(chosen)
                    if not waste:
                        break
                i = min(i, bisect.bisect_right(rising, room) - 1)
            else:
                i -= 1
            continue
        if not chosen:
            break
        x = chosen.pop()
        used[x] -= 1
        room += x
        i = bisect.bisect_left(rising, x) - 1
    return tuple(best)


class Spent(Exception):
    """The nodes of a search are used up."""


def fewer(counts: Counter, bins: int, capacity: int, branch: int) -> list[tuple[int, ...]] | None:
    """All of ``counts`` in at most ``bins`` sequences by bin completion, or None if there is no such packing; raises :class:`Spent` after ``branch`` nodes."""
    left, rising, dead = dict(counts), sorted(counts), set()
    nodes = 0

    def dominated(chosen: list[int], room: int) -> bool:
        """Whether a piece that is left can take the place of one that is chosen, or of two, and fill more or be one instead of two."""
        kinds = sorted(set(chosen))
        pairs = {a + b for i, a in enumerate(kinds) for b in kinds[i:] if a != b or chosen.count(a) > 1}
        return any(left[x] and (any(k < x <= k + room for k in kinds) or any(p <= x <= p + room for p in pairs)) for x in rising)

    def fillings(room: int, top: int, slack: int, chosen: list[int]) -> Iterator[int]:
        """Takes an undominated filling from ``left`` into ``chosen`` and yields the room it leaves; puts it back afterwards."""
        nonlocal nodes
        nodes += 1
        if nodes > branch:
            raise Spent
        for i in range(min(top, bisect.bisect_right(rising, room) - 1), -1, -1):
            x = rising[i]
            for k in range(min(left[x], room // x), 0, -1):
                left[x] -= k
                chosen += [x] * k
                yield from fillings(room - k * x, i - 1, slack, chosen)
                del chosen[len(chosen) - k :]
                left[x] += k
        if room <= slack and not any(x <= room and left[x] for x in rising) and not dominated(chosen, room):
            yield room

    def solve(slack: int) -> list[tuple[int, ...]] | None:
        big = next((x for x in reversed(rising) if left[x]), None)
        if big is None:
            return []
        state = tuple(left[x] for x in rising)
        if state in dead:
            return None
        left[big] -= 1
        chosen: list[int] = []
        for room in fillings(capacity - big, len(rising) - 1, slack, chosen):
            pattern = (big, *chosen)
            rest = solve(slack - room)
            if rest is not None:
                return [pattern, *rest]
        left[big] += 1
        dead.add(state)
        return None

    slack = bins * capacity - sum(x * k for x, k in counts.items())
    return None if slack < 0 else solve(slack)


def improved(patterns: list[tuple[tuple[int, ...], int]], capacity: int, branch: int) -> list[tuple[tuple[int, ...], int]]:
    """The same pieces in fewer sequences, where ``fewer`` finds a way for the last 2, 4, ... ``WINDOW`` of them."""
    patterns = list(patterns)
    total, bins, size = sum(sum(p) * n for p, n in patterns), sum(n for _, n in patterns), 2
    while bins > -(-total // capacity):
        tail: list[tuple[int, ...]] = []
        while patterns and len(tail) < size:
            pattern, n = patterns.pop()
            k = min(n, size - len(tail))
            tail += [pattern] * k
            if n > k:
                patterns.append((pattern, n - k))
        try:
            found = fewer(Counter(x for p in tail for x in p), len(tail) - 1, capacity, branch)
        except Spent:
            found = None
        patterns += [(p, 1) for p in (tail if found is None else found)]
        if found is not None:
            bins -= len(tail) - len(found)
        elif size >= min(WINDOW, bins):
            break
        else:
            size = min(2 * size, WINDOW)
    return patterns


def complete(counts: dict[int, int], capacity: int = CAPACITY, branch: int = 2000, search: int = 100_000) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths of one sequence, falling) and how often each is used, for ``counts`` pieces of every length. ``branch`` bounds the nodes of
    one sequence's search, ``search`` those of one search over the last sequences."""
    return improved(completed(counts, capacity, branch), capacity, search)


def completed(counts: dict[int, int], capacity: int, branch: int) -> list[tuple[tuple[int, ...], int]]:
    """The incumbent: one sequence after the other is completed for the largest piece left."""
    left = {k: v for k, v in counts.items() if v > 0}
    rising, out = sorted(left), []
    while rising:
        big = rising[-1]
        left[big] -= 1
        pool = rising[: bisect.bisect_right(rising, capacity - big)]
        if pool and not left[pool[-1]]:
            pool.pop()
        pattern = (big, *filling(capacity - big, pool, left, branch))
        left[big] += 1
        need = Counter(pattern)
        times = min(left[x] // k for x, k in need.items())
        for x, k in need.items():
            left[x] -= times * k
            if not left[x]:
                del left[x]
                del rising[bisect.bisect_left(rising, x)]
        out.append((pattern, times))
    return out


def intervals(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """By length: rows of first rank, first sequence, pieces per sequence, offset of the first one."""
    rank: dict[int, int] = {}
    found: dict[int, list] = {}
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for x in dict.fromkeys(pattern):
            k = pattern.count(x)
            found.setdefault(x, []).append((rank.get(x, 0), sequence, k, offset))
            rank[x] = rank.get(x, 0) + times * k
            offset += x * k
        sequence += times
    return {x: np.array(rows, np.int64) for x, rows in found.items()}


def ranked(found: DataFrame, salt: int) -> DataFrame:
    """Adds ``rank``, 0, 1, ... within each length, numbered in ``salt`` groups, as one length may be that of most pieces."""
    keyed = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salt)).cast("int"))
    groups = stored(keyed.groupBy("length", "salt").count(), "length-groups")
    before = F.sum("count").over(Window.partitionBy("length").orderBy("salt")) - F.col("count")
    shift = groups.select(F.col("length").alias("len"), F.col("salt").alias("slt"), before.alias("before"))
    number = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32"))
    numbered = keyed.withColumn("number", number - 1)
    return numbered.join(shift, (F.col("length") == F.col("len")) & (F.col("salt") == F.col("slt"))).select(
        *found.columns, (F.col("number") + F.col("before")).alias("rank"))


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``.

    ``found`` should be a stored table: it is read for the histogram, the ranks and the result. Repeated rows are pieces of their own.
    """
    hist = {r["length"]: r["count"] for r in found.groupBy("length").count().collect()}  # at most ``capacity`` rows
    where = intervals(complete(hist, capacity))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sequence, offset = np.empty(len(pdf), np.int64), np.empty(len(pdf), np.int64)
            rank, length = pdf["rank"].to_numpy(), pdf["length"].to_numpy()
            for x in np.unique(length):
                at = np.flatnonzero(length == x)
                rows = where[int(x)]
                hit = rows[np.searchsorted(rows[:, 0], rank[at], side="right") - 1]
                j = rank[at] - hit[:, 0]
                sequence[at], offset[at] = hit[:, 1] + j // hit[:, 2], hit[:, 3] + j % hit[:, 2] * x
            yield pdf.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema.fields) + ", sequence_id long, offset long"
    return ranked(found, max(64, sum(hist.values()) // 50_000)).mapInPandas(place, schema)


def sequences(docs: DataFrame, file: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The sequences themselves: ``sequence_id``, ``length``, ``ids``. A sequence is at most ``capacity`` ids, so its group is bounded."""
    placed = pack(stored(pieces(docs, file, capacity, with_ids=True), "pieces"), capacity)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.flatten(F.transform(parts, lambda p: p.ids)).alias("ids"))


def packed(docs: DataFrame, file: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    return pack(stored(pieces(docs, file, capacity), "pieces"), capacity)


@query("op4_best_fit_packing")
def op4(spark, folder):
    return packed(table(spark, folder, "documents"))
