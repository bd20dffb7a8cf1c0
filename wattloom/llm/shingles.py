"""Word shingle sets of many texts at once, as 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], "<u8")
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _M2
    return h ^ (h >> np.uint64(29))


def word_hashes(buf: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of each word of ``buf``. Words are read eight bytes at a time, all words together."""
    raw = np.frombuffer(buf + b" " * 8, np.uint8)
    inside = ~SPACE[raw]
    edge = np.flatnonzero(np.diff(inside, prepend=False))
    start, end = edge[0::2], edge[1::2]
    eight = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
    left = end - start
    h = left.astype(np.uint64) * _M1
    on = np.arange(len(start))
    at = start
    while len(on):
        size = np.minimum(left[on], 8)
        h[on] = _mix((h[on] ^ (eight[at] & _KEEP[size])) * _M1)
        left[on] -= size
        more = left[on] > 0
        on, at = on[more], at[more] + 8
    return start, end, h


def shingle_sets(texts: list[str | None], width: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text.

    A-Z are lower-cased; words are runs of anything but ASCII white space. A text with fewer words than
    ``width`` has one shingle, the whole sequence; without words, or NULL, it has none.
    """
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass").lower() for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw])
    start, _, h = word_hashes(b"\n".join(raw) + b"\n")
    first = np.searchsorted(start, np.concatenate([[0], ends]))
    count = np.diff(first)
    rolled = h[: max(0, len(h) - width + 1)].copy()
    for k in range(1, width):
        rolled = _mix(rolled * _M1 + h[k : len(rolled) + k])
    out = []
    for a, n in zip(first[:-1], count, strict=True):
        if n >= width:
            out.append(np.unique(rolled[a : a + n - width + 1]))
        elif n:
            out.append(np.array([xxhash.xxh3_64_intdigest(h[a : a + n].tobytes(), seed=int(n))], np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def set_key(s: np.ndarray) -> int:
    """Signed 64-bit digest of a set; equal sets have equal keys."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes(), seed=len(s))).astype(np.int64))


def text_groups(batches: Iterator[pa.RecordBatch], size: int = 4 << 20):
    """Texts (the first column) of each batch in groups of about ``size`` characters, and the group's other columns."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy(zero_copy_only=False))
        a = 0
        while a < len(batch):
            b = max(a + 1, int(np.searchsorted(sizes, (sizes[a - 1] if a else 0) + size)))
            part = batch.slice(a, b - a)
            yield part.columns[1:], part.column(0).to_pylist()
            a = b
