"""Substring dedup by recompression.

Each document is a string of word symbols. A round names every maximal run of
one symbol, later rounds split the symbols in two halves and name every pair
(left-half symbol, right-half symbol); the named parts become the symbols of
the next round. Names are 64-bit hashes of what they stand for, so they are the
same everywhere without a table of names, and equal substrings get equal
symbols but for a few at their edges. For each symbol the words on which its
forming depended are kept.

Spark then counts the high-level symbols of the corpus. A symbol that occurs
once in the whole corpus rules out every window that covers its words of
dependence: were the window repeated, so would be the symbol. Only windows that
no such symbol rules out - repeats, and few others - are verified by hashes of
all their words, counted over the corpus.

Both counts ask per block of documents and distinct key (see ``blocks``): a
passage that a third of all documents share costs one row a block.

Rules (``window_report``): words are parted by ASCII white space. A window is
``length`` consecutive words of one document; every word covered by a window
whose word sequence also starts anywhere else goes.

Edge cases: null and empty texts, and texts of fewer words than a window, lose
nothing; their kept text is their words joined by one space. Repeated rows are
copies of each other and lose all windows. An empty table gives an empty
result. Names and windows are compared by hashes (64 bits a word, 96 a window).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.llm import blocks as B
from fundlake.llm.scratch import Scratch
from fundlake.llm.tokens import U64, Words, covered, mix, span_hash, windows, words_of

LENGTH = 35
#: Pair rounds; after six, a symbol stands for about six words.
ROUNDS = 6
_I64 = np.int64


def recompress(symbols: np.ndarray, off: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of the symbols after one run round and some pair rounds, and the words [lo, hi) each depends on.

    off: where each document begins, and the end. A symbol at the edge of a
    document depends on a word beyond it, which no window holds."""
    n = len(symbols)
    if n == 0:
        return symbols, np.zeros(0, _I64), np.zeros(0, _I64)
    edge = np.zeros(n + 1, dtype=bool)
    edge[off] = True
    first = np.flatnonzero(np.r_[True, (symbols[1:] != symbols[:-1]) | edge[1:n]])
    last = np.append(first[1:], n)
    name = mix(symbols[first] + mix((last - first).astype(U64)))
    lo, hi, starts = first - 1, last + 1, edge[first]
    for level in range(rounds):
        right = mix(name ^ U64(0x5851F42D4C957F2D * (level + 1) % (1 << 64))) & U64(1) == 1
        m = len(name)
        joined = np.zeros(m, dtype=bool)  # with the next symbol
        joined[:-1] = ~right[:-1] & right[1:] & ~starts[1:]
        second = np.r_[False, joined[:-1]]
        # What decided the fate of a symbol: a left one looks at the next, a right one at the one before.
        before, after = np.r_[lo[0] - 1, lo[:-1]], np.r_[hi[1:], hi[-1] + 1]
        before = np.where(starts, lo - 1, before)
        after = np.where(np.r_[starts[1:], True], hi + 1, after)
        new_lo = np.where(joined, lo, np.where(right, np.minimum(lo, before), lo))
        new_hi = np.where(joined, np.r_[hi[1:], 0], np.where(right, hi, np.maximum(hi, after)))
        pair = mix(name * U64(0xD6E8FEB86659FD93) + mix(np.r_[name[1:], U64(0)]) + U64(level))
        keep = ~second
        name, lo, hi, starts = np.where(joined, pair, name)[keep], new_lo[keep], new_hi[keep], starts[keep]
    return name, lo, hi


def _ruled_out(alone: np.ndarray, lo: np.ndarray, hi: np.ndarray, start: np.ndarray, doc_end: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which window starts have a lone symbol whose words of dependence they cover."""
    a, b = np.maximum(hi[alone] - length, 0), lo[alone] + 1
    ok = (a < b) & (b <= n)
    step = np.bincount(a[ok], minlength=n + 1) - np.bincount(b[ok], minlength=n + 1)
    return np.cumsum(step[:n])[start] > 0


def _distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, where each first stands, and how often, but 2 at most."""
    keys, first, n = np.unique(key, return_index=True, return_counts=True)
    return keys, first, np.minimum(n, 2)


def _symbols(table: pa.Table, rounds: int) -> tuple[Words, np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    words = words_of(table["text"])
    h = words.hashes()
    return words, h, recompress(h, words.off, rounds)


def _starts(words: Words, h: np.ndarray, parsed: tuple[np.ndarray, np.ndarray, np.ndarray], shared: np.ndarray, length: int) -> np.ndarray:
    """Starts of the windows that no lone symbol rules out."""
    name, lo, hi = parsed
    at, doc = windows(words.off, length)
    if not len(at):
        return at
    alone = ~np.isin(name, shared)
    return at[~_ruled_out(alone, lo, hi, at, words.off[doc + 1], length, len(h))]


def _prints(h: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    return span_hash(h, at, at + length, 0), (span_hash(h, at, at + length, 1) >> U64(32)).astype(np.uint32)


def _repeats(docs: DataFrame, length: int, rounds: int, work: Scratch) -> DataFrame:
    """Blocks of docs with the hashes of the windows there that start more than once in the corpus."""
    packed = B.store(docs, work, "substring-blocks")

    def name_symbols(block: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
        keys, _, n = _distinct(_symbols(table, rounds)[2][0])
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(_I64)), pa.array(np.full(len(keys), block)), pa.array(n.astype(np.int8))], names=["symbol", "block", "n"])

    named = B.each(packed, name_symbols, "symbol long, block long, n byte")
    shared = B.totals(named, packed, ["symbol"], total="sum(n)").where("total > 1")

    def verify(block: int, table: pa.Table, symbols: pa.Scalar) -> Iterator[pa.RecordBatch]:
        words, h, parsed = _symbols(table, rounds)
        at = _starts(words, h, parsed, _longs(symbols), length)
        a, b = _prints(h, at, length)
        keys, first, n = _distinct(a)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(_I64)), pa.array(b[first].view(np.int32)), pa.array(np.full(len(keys), block)), pa.array(n.astype(np.int8))], names=["a", "b", "block", "n"])

    candidates = B.each(B.reply(packed, shared, symbols="symbol"), verify, "a long, b int, block long, n byte")
    repeated = B.totals(candidates, packed, ["a", "b"], total="sum(n)").where("total > 1")
    return B.reply(packed, repeated, a="a", b="b")


def _longs(x: pa.Scalar) -> np.ndarray:
    return x.values.to_numpy(zero_copy_only=False).view(U64) if x.is_valid else np.zeros(0, U64)


def members(a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray) -> np.ndarray:
    """Which pairs (a, b) are among the pairs (of_a, of_b)."""
    order = np.lexsort((of_b, of_a))
    of_a, of_b = of_a[order], of_b[order]
    out, open_ = np.zeros(len(a), bool), np.arange(len(a))
    at = np.searchsorted(of_a, a)
    while len(open_) and len(of_a):  # once, but where different pairs share an a
        here = (at < len(of_a)) & (of_a[np.minimum(at, len(of_a) - 1)] == a[open_])
        open_, at = open_[here], at[here]
        same = of_b[at] == b[open_]
        out[open_[same]] = True
        open_, at = open_[~same], at[~same] + 1
    return out


def _gone(table: pa.Table, a: pa.Scalar, b: pa.Scalar, length: int) -> tuple[Words, np.ndarray]:
    words = words_of(table["text"])
    h = words.hashes()
    at, _ = windows(words.off, length)
    if not a.is_valid or not len(a.values) or not len(at):
        return words, np.zeros(len(h), bool)
    hits = _longs(a)
    at = at[np.isin(span_hash(h, at, at + length, 0), hits)]
    found = members(*_prints(h, at, length), hits, b.values.to_numpy(zero_copy_only=False).view(np.uint32))
    return words, covered(at[found], length, len(h))


def _texts(words: Words, gone: np.ndarray) -> Iterator[bytes]:
    """Kept words of each document joined by one space."""
    data, start, end = words.data.tobytes(), words.start.tolist(), words.end.tolist()
    for d, (a, b) in enumerate(zip(words.off[:-1].tolist(), words.off[1:].tolist(), strict=True)):
        if not gone[a:b].any():
            yield b" ".join(data[words.doc_off[d] : words.doc_off[d + 1]].split())
        else:
            yield b" ".join([data[start[i] : end[i]] for i in (np.flatnonzero(~gone[a:b]) + a).tolist()])


def window_report(docs: DataFrame, length: int = LENGTH, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space)."""

    def run(block: int, table: pa.Table, a: pa.Scalar, b: pa.Scalar) -> Iterator[pa.RecordBatch]:
        words, gone = _gone(table, a, b, length)
        total = np.concatenate([[0], np.cumsum(gone)])
        sha = [hashlib.sha256(x).hexdigest() for x in _texts(words, gone)]
        yield pa.RecordBatch.from_arrays([table["doc_id"].combine_chunks(), pa.array(words.counts().astype(_I64)), pa.array((total[words.off[1:]] - total[words.off[:-1]]).astype(_I64)), pa.array(sha, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    work = Scratch(docs.sparkSession)
    blocks = _repeats(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), length, rounds, work)
    return B.each(blocks, run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = LENGTH, rounds: int = ROUNDS, scope: str | None = None) -> DataFrame:
    """docs with every repeated window's words taken out of text; texts that lose nothing stay as they are."""
    schema = docs.schema

    def run(block: int, table: pa.Table, a: pa.Scalar, b: pa.Scalar) -> Iterator[pa.RecordBatch]:
        words, gone = _gone(table, a, b, length)
        total = np.concatenate([[0], np.cumsum(gone)])
        lost = total[words.off[1:]] > total[words.off[:-1]]
        texts = [new.decode("utf-8", "replace") if x else old for new, x, old in zip(_texts(words, gone), lost, table["text"].to_pylist(), strict=True)]
        at = table.schema.get_field_index("text")
        yield from table.set_column(at, "text", pa.array(texts, table.schema.field("text").type)).combine_chunks().to_batches()

    return B.each(_repeats(docs, length, rounds, Scratch(docs.sparkSession, scope)), run, schema)
