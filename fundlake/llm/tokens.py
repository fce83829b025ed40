"""Columnar tokeniser: words and their 64-bit hashes straight from UTF-8 bytes.

All functions work on one concatenated byte array with document offsets, so a
batch of thousands of documents costs a handful of numpy passes and no Python
loop over words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes that part words: U+0020 and U+0009..U+000D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes that part alphanumeric words: all ASCII but 0-9 and a-z (after lower-casing).
NOT_ALNUM = np.zeros(256, dtype=bool)
NOT_ALNUM[:0x80] = True
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_MULT = U64(0x9E3779B97F4A7C15)
_BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (splitmix)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE = mix((np.arange(256, dtype=U64) + U64(1)) * _MULT)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


#: Values hashed at once; it bounds the memory of a pass.
_PASS = 1 << 19


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            x = np.full(max(n, 2 * _PASS), b, dtype=U64)
            x[0] = 1
            both.append(np.cumprod(x, dtype=U64))
        have = both[0], both[1]
        if n <= 2 * _PASS:  # else an unusually long span: not worth keeping
            _POWERS[base] = have
    return have


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int = 0, table: np.ndarray | None = None) -> np.ndarray:
    """Hash of values[s:e] (of table[values[s:e]]) for each (s, e), both ascending.

    The same content gives the same hash wherever it stands."""
    out = np.empty(len(starts), dtype=U64)
    i = 0
    while i < len(starts):
        at = int(starts[i])
        j = int(np.searchsorted(starts, at + _PASS))
        s, e = starts[i:j] - at, ends[i:j] - at
        n = int(e[-1])
        up, down = powers(_BASES[family], n + 1)
        part = values[at : at + n] if table is None else table[values[at : at + n]]
        prefix = np.zeros(n + 1, dtype=U64)
        np.cumsum(part * up[:n], dtype=U64, out=prefix[1:])
        out[i:j] = (prefix[e] - prefix[s]) * down[s] + (e - s).astype(U64) * _MULT
        i = j
    return mix(out)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    _, off, data = column.buffers()
    if n == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Words of a batch: byte spans [start, end), and for document d the words off[d]:off[d+1]."""

    __slots__ = ("data", "doc_off", "start", "end", "off")

    def __init__(self, data: np.ndarray, doc_off: np.ndarray, parts: np.ndarray = SPACE):
        self.data, self.doc_off = data, doc_off
        n = len(data)
        word = np.zeros(n + 2, dtype=bool)
        word[1:-1] = ~parts[data]
        first = np.zeros(n + 1, dtype=bool)
        first[doc_off] = True
        self.start = np.flatnonzero(word[1:] & (~word[:-1] | first))
        self.end = np.flatnonzero(word[:-1] & (~word[1:] | first))
        self.off = np.searchsorted(self.start, doc_off)

    def hashes(self, family: int = 0) -> np.ndarray:
        return span_hash(self.data, self.start, self.end, family, _BYTE)

    def counts(self) -> np.ndarray:
        return np.diff(self.off)

    def docs(self) -> np.ndarray:
        """Document of each word."""
        return np.repeat(np.arange(len(self.off) - 1), np.diff(self.off))


def words_of(column: pa.Array, lower: bool = False, parts: np.ndarray = SPACE) -> Words:
    data, off = buffers(column)
    return Words(LOWER[data] if lower else data, off, parts)


def windows(off: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all runs of length words inside one document, and the document of each."""
    n = np.maximum(np.diff(off) - length + 1, 0)
    docs = np.repeat(np.arange(len(n)), n)
    first = np.cumsum(n) - n
    return np.arange(int(n.sum())) - first[docs] + off[:-1][docs], docs


def covered(starts: np.ndarray, length: int | np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in a span that begins at one of starts."""
    step = np.bincount(starts, minlength=n + 1) - np.bincount(starts + length, minlength=n + 1)
    return np.cumsum(step[:n]) > 0
