"""Word hashing over Arrow text columns, shared by the operators that work on
hashed words.

A text column is read straight from its Arrow buffers, so no Python string is
made per word.  Work goes through slices of about `CHUNK_BYTES` of text; one
text longer than that is a slice of its own.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))


def process_state(name: str, make):
    """A value kept for the life of a Python worker process.  Functions are
    shipped to workers by value, so module globals don't outlive a task."""
    box = sys.modules.setdefault("_spark_recs_worker_state", types.ModuleType("_spark_recs_worker_state"))
    if not hasattr(box, name):
        setattr(box, name, make())
    return getattr(box, name)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_table() -> np.ndarray:
    t = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    t[65:91] = t[97:123]  # A-Z hash as a-z
    return t


def space_separators() -> np.ndarray:
    """Words are runs of anything but space and \\t \\n \\v \\f \\r."""
    sep = np.zeros(256, dtype=bool)
    sep[[0x20, *range(0x09, 0x0E)]] = True
    return sep


def punctuation_separators() -> np.ndarray:
    """Words are runs of ASCII letters, digits and non-ASCII characters."""
    sep = np.ones(256, dtype=bool)
    sep[0x80:] = False
    for lo, hi in ((48, 58), (65, 91), (97, 123)):
        sep[lo:hi] = False
    return sep


#: Code points of scripts that write no spaces: Thai, Lao, Tibetan, Myanmar, Khmer, Chinese, Japanese.
UNSPACED = [(0x0E00, 0x0F00), (0x0F00, 0x1000), (0x1000, 0x10A0), (0x1780, 0x1800), (0x2E80, 0x3000), (0x3040, 0xA000),
            (0xF900, 0xFB00), (0xFF66, 0xFFA0), (0x1B000, 0x1B170), (0x20000, 0x40000)]
#: Their punctuation, which separates words.
UNSPACED_MARKS = [(0x3000, 0x3005), (0x3008, 0x3021), (0x3030, 0x3031), (0xFF00, 0xFF10), (0xFF1A, 0xFF21), (0xFF3B, 0xFF41), (0xFF5B, 0xFF66)]


def _within(points: np.ndarray, ranges: list[tuple[int, int]]) -> np.ndarray:
    return np.searchsorted(np.array(ranges).ravel(), points, side="right") % 2 == 1


def _wide_characters(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, bytes, code point) of the characters of three and four bytes."""
    at = np.flatnonzero(buf >= 0xE0)
    width = np.where(buf[at] >= 0xF0, 4, 3)
    whole = at + width <= len(buf)
    at, width = at[whole], width[whole]
    points = buf[at].astype(np.int64) & np.where(width == 4, 7, 15)
    for j in (1, 2, 3):
        here = width > j
        points[here] = points[here] << 6 | (buf[at[here] + j] & 63)
    return at, width, points


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_P, _P_INV):
        p = np.ones(n, dtype=np.uint64)
        p[1:] = base
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): row i is bytes[offsets[i]:offsets[i + 1]]; a null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    offsets = np.frombuffer(col.buffers()[1], dtype=kind)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw, offsets


def row_slices(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes each, at least one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, j
        i = j


class WordHasher:
    """64-bit hashes of the words of texts, A-Z taken as a-z.  `characters`:
    each character of a script without spaces is a word."""

    def __init__(self, separators: np.ndarray, characters: bool = False):
        self.sep, self.table, self.characters = separators, _byte_table(), characters
        self.pw, self.pinv = _powers(2 * CHUNK_BYTES)

    def __call__(self, raw: np.ndarray, offsets: np.ndarray, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
        """(hashes, first): the words of row i are hashes[first[i]:first[i + 1]];
        then, for each of `prefixes`, the hashes of the words' first so many bytes."""
        lo = int(offsets[0])
        buf, off = raw[lo: int(offsets[-1])], offsets - lo
        if len(buf) == 0:
            none = np.zeros(0, dtype=np.uint64)
            return none, np.zeros(len(off), dtype=np.int64), *[none] * len(prefixes)
        if len(buf) > len(self.pw):
            self.pw, self.pinv = _powers(len(buf))
        word = ~self.sep[buf]
        edge = np.zeros(len(buf) + 1, dtype=bool)
        edge[off] = True
        if self.characters:
            at, width, points = _wide_characters(buf)
            alone, mark = _within(points, UNSPACED), _within(points, UNSPACED_MARKS)
            for j in range(3):  # no mark has four bytes
                word[at[mark] + j] = False
            edge[at[alone]] = edge[at[alone] + width[alone]] = True
        start = word.copy()
        start[1:] &= ~word[:-1] | edge[1:-1]
        end = word.copy()
        end[:-1] &= ~word[1:] | edge[1:-1]
        s, e = np.flatnonzero(start), np.flatnonzero(end)
        acc = np.zeros(len(buf) + 1, dtype=np.uint64)
        np.cumsum(self.table[buf] * self.pw[: len(buf)], out=acc[1:])
        h = mix64((acc[e + 1] - acc[s]) * self.pinv[s] + (e - s).astype(np.uint64))
        heads = [mix64((acc[np.minimum(e + 1, s + k)] - acc[s]) * self.pinv[s] + np.uint64(k << 32)) for k in prefixes]
        return h, np.searchsorted(s, off), *heads


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive words; the caller cuts at row ends."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out = mix64(out + h[j: j + n] * np.uint64(2 * j + 1) + np.uint64(0x632BE59BD9B4E019))
    return out
