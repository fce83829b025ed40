"""Benchmark decontamination by a distributed positional inverted index.

``build_index`` stores postings (word positions) of every training token that
stands in the benchmark at all, one index segment per block of documents, as a
table in the shared folder. Searching a phrase takes the posting list of its
rarest term (by frequency over the whole corpus), moves each list by the term's
offset in the phrase, and intersects them from the rarest on until none is left
or all words are matched; lists of other segments are never joined. ``proximity``
finds places where all terms stand near the rarest one.

Rules (``contamination``): A-Z is lower-cased; words are maximal runs of ASCII
letters, digits and non-ASCII characters. An item's windows are its runs of
``window`` words; an item of fewer, but not none, is one window. A word of a
document inside any occurrence of a window is hit.

The benchmark is searched in chunks of items of about ``CHUNK_BYTES`` of text;
a chunk's distinct windows are broadcast as arrays of term numbers, some ten
times its size. All chunks share one index if the benchmark has at most
``MAX_TERMS`` different words; else each chunk has an index of its own terms. So
what is broadcast is bounded however large the benchmark is, but for the text
of a single item.

Edge cases: null and empty texts have no words and hit nothing. Items without
words, or an empty benchmark, hit nothing. Repeated items each count; repeated
documents each get a row. A null item_id is named ``null``.
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
from fundlake.llm.tokens import NOT_ALNUM, words_of

WINDOW = 10
#: Bytes of benchmark text whose phrases are broadcast at once, and the different words of a shared index.
CHUNK_BYTES, MAX_TERMS = 4 << 20, 1 << 20
_SEGMENT = "block long, doc_id binary, word_off binary, term binary, post_off binary, position binary"
_I64, _I32 = np.int64, np.int32


def _chunks(items: DataFrame) -> list[DataFrame]:
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // CHUNK_BYTES)
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) for i in range(n)]


class Phrases:
    """The distinct windows of some items: rows of term numbers (-1 after the end), and the items of each."""

    def __init__(self, items: DataFrame, window: int, vocabulary: np.ndarray | None = None):
        """vocabulary: sorted hashes of at least the items' words; by default just these."""
        rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("i"), "text").toArrow()
        words = words_of(rows["text"], lower=True, parts=NOT_ALNUM)
        h = words.hashes()
        self.vocabulary = np.unique(h) if vocabulary is None else vocabulary
        number = np.searchsorted(self.vocabulary, h).astype(_I32)
        n = words.counts()
        have = np.where(n > 0, np.maximum(n - window, 0) + 1, 0)
        item = np.repeat(np.arange(len(n)), have)
        start = np.arange(int(have.sum())) - (np.cumsum(have) - have)[item] + words.off[:-1][item]
        at = start[:, None] + np.arange(window)
        inside = at < words.off[1:][item][:, None]
        terms = np.where(inside, number[np.minimum(at, max(len(number) - 1, 0))], -1).astype(_I32) if len(number) else np.zeros((0, window), _I32)
        self.names = rows["i"].to_pylist()
        self.terms, of = np.unique(terms, axis=0, return_inverse=True)
        pairs = np.unique(np.stack([of.ravel(), item]), axis=1) if len(item) else np.zeros((2, 0), np.int64)
        self.items, self.item_off = pairs[1], np.searchsorted(pairs[0], np.arange(len(self.terms) + 1))

    def ordered(self, rarity: np.ndarray) -> None:
        """Keep the windows all of whose terms occur, by their rarest; each with its offsets from the rarest term on."""
        at = np.append(rarity, np.iinfo(_I64).max)[self.terms]  # what is after the end comes last
        keep = np.flatnonzero((at > 0).all(axis=1))
        order = np.argsort(at[keep], axis=1, kind="stable").astype(np.int8)
        rarest = np.take_along_axis(self.terms[keep], order[:, :1].astype(_I64), axis=1)[:, 0]
        by = np.argsort(rarest, kind="stable")
        self.windows, self.order = keep[by], order[by]
        self.rarest, self.first = np.unique(rarest[by], return_index=True)
        self.first = np.append(self.first, len(by))

    def within(self, held: np.ndarray) -> Iterator[tuple[list[int], list[int], np.ndarray]]:
        """Terms, offsets from the rarest on, and items of each window whose rarest term is among held."""
        for i in np.flatnonzero(np.isin(self.rarest, held)).tolist():
            for j in range(self.first[i], self.first[i + 1]):
                w = self.windows[j]
                terms = self.terms[w][self.terms[w] >= 0].tolist()
                yield terms, self.order[j][: len(terms)].tolist(), self.items[self.item_off[w] : self.item_off[w + 1]]


def shared_vocabulary(items: DataFrame) -> np.ndarray | None:
    """Sorted hashes of all items' words, if they are not too many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(words_of(batch["text"], lower=True, parts=NOT_ALNUM).hashes()).view(_I64))], names=["h"])

    found = items.select("text").mapInArrow(run, "h long").distinct().limit(MAX_TERMS + 1).toArrow()["h"].to_numpy()
    return None if len(found) > MAX_TERMS else np.sort(found.view(np.uint64))


def build_index(packed: DataFrame, vocabulary: np.ndarray, buckets: int, work: Scratch) -> DataFrame:
    """One segment per block: for each term of the vocabulary that stands there, the positions of its words."""
    shared = packed.sparkSession.sparkContext.broadcast(vocabulary)

    def run(block: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        words = words_of(table["text"], lower=True, parts=NOT_ALNUM)
        h = words.hashes()
        low = np.zeros(1 << 20, dtype=bool)
        low[(terms & np.uint64(0xFFFFF)).astype(_I64)] = True
        at = np.flatnonzero(low[(h & np.uint64(0xFFFFF)).astype(_I64)])
        number = np.minimum(np.searchsorted(terms, h[at]), max(len(terms) - 1, 0))
        same = terms[number] == h[at] if len(terms) else np.zeros(len(at), bool)
        at, number = at[same], number[same]
        order = np.argsort(number, kind="stable")
        held, first = np.unique(number[order], return_index=True)
        ids = table["doc_id"].combine_chunks()
        arrays = (np.append(first, len(order)).astype(_I64), at[order].astype(_I32))
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), *[pa.array([x], pa.binary()) for x in (B.encode(pa.table({"doc_id": ids})), words.off.astype(_I64).tobytes(), held.astype(_I32).tobytes(), *[x.tobytes() for x in arrays])]],
            names=["block", "doc_id", "word_off", "term", "post_off", "position"],
        )

    return work.keep(B.each(packed, run, _SEGMENT), "postings", ("block", buckets))


def frequencies(index: DataFrame, n: int) -> np.ndarray:
    """Occurrences of each of n terms in the whole corpus, from the stored lists' lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n, dtype=_I64)
        for batch in batches:
            for term, off in zip(batch["term"], batch["post_off"], strict=True):
                total[np.frombuffer(term.as_buffer(), _I32)] += np.diff(np.frombuffer(off.as_buffer(), _I64))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "n"])

    out = np.zeros(n, dtype=_I64)
    rows = index.select("term", "post_off").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out[rows["term"].to_numpy()] = rows["n"].to_numpy()
    return out


class Segment:
    """The postings of one block."""

    def __init__(self, row: dict):
        self.word_off = np.frombuffer(row["word_off"], _I64)
        off, self.position = np.frombuffer(row["post_off"], _I64), np.frombuffer(row["position"], _I32)
        self.lists = {int(t): (int(a), int(b)) for t, a, b in zip(np.frombuffer(row["term"], _I32), off[:-1], off[1:], strict=True)}

    def of(self, term: int) -> np.ndarray | None:
        span = self.lists.get(term)
        return None if span is None else self.position[span[0] : span[1]]

    def docs(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.word_off, at, "right") - 1

    def phrase(self, terms: list[int], order: list[int]) -> np.ndarray:
        """Starts of all occurrences of the phrase; order: offsets in the phrase from the rarest term on."""
        if any(t not in self.lists for t in terms):
            return np.zeros(0, _I32)
        at = self.of(terms[order[0]]) - _I32(order[0])
        for k in order[1:]:
            if not len(at):
                return at
            other = self.of(terms[k])
            found = np.searchsorted(other, at + _I32(k))
            at = at[other[np.minimum(found, len(other) - 1)] == at + _I32(k)]
        if not len(at):
            return at
        at = at[at >= 0]
        return at[at + len(terms) <= self.word_off[self.docs(at) + 1]]

    def near(self, terms: list[int], within: int) -> np.ndarray:
        """Occurrences of the first (rarest) term that have all others within so many words, in their document."""
        if any(t not in self.lists for t in terms):
            return np.zeros(0, _I32)
        at = self.of(terms[0])
        for t in terms[1:]:
            doc = self.docs(at)
            lo, hi = np.maximum(at - within, self.word_off[doc]), np.minimum(at + within + 1, self.word_off[doc + 1])
            other = self.of(t)
            at = at[np.searchsorted(other, lo) < np.searchsorted(other, hi)]
        return at


def _search(index: DataFrame, phrases: Phrases) -> DataFrame:
    """(block, row of the block, item, words [start, end) of the block) of every occurrence, overlapping ones joined."""
    phrases.ordered(frequencies(index, len(phrases.vocabulary)))
    phrases.vocabulary = None  # the index has it
    shared = index.sparkSession.sparkContext.broadcast(phrases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                segment, spans = Segment(row), {}
                for terms, order, items in phrases.within(np.frombuffer(row["term"], _I32)):
                    if len(at := segment.phrase(terms, order)):
                        for item in items.tolist():
                            spans.setdefault(item, []).append((at.astype(_I64), len(terms)))
                rows, items, starts, ends = [], [], [], []
                for item, parts in spans.items():
                    at = np.concatenate([x for x, _ in parts])
                    end = np.concatenate([x + n for x, n in parts])
                    order = np.argsort(at, kind="stable")
                    at, end, doc = at[order], np.maximum.accumulate(end[order]), segment.docs(at[order])
                    new = np.r_[True, (at[1:] > end[:-1]) | (doc[1:] != doc[:-1])]
                    first = np.flatnonzero(new)
                    rows += doc[first].tolist()
                    items += [phrases.names[item]] * len(first)
                    starts += at[first].tolist()
                    ends += end[np.append(first[1:], len(at)) - 1].tolist()
                yield pa.RecordBatch.from_arrays([pa.array([row["block"]] * len(rows), pa.int64()), pa.array(rows, pa.int64()), pa.array(items, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], names=["block", "row", "item", "start", "end"])

    return index.select("block", "word_off", "term", "post_off", "position").mapInArrow(run, "block long, row long, item string, start long, end long")


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            off, ids = np.frombuffer(row["word_off"], _I64), B.decode(row["doc_id"])["doc_id"].combine_chunks()
            hit, items = np.zeros(len(ids), _I64), {}
            if row["row"]:
                step = np.zeros(off[-1] + 1, _I64)
                np.add.at(step, np.array(row["start"]), 1)
                np.add.at(step, np.array(row["end"]), -1)
                total = np.concatenate([[0], np.cumsum(np.cumsum(step[:-1]) > 0)])
                hit = total[off[1:]] - total[off[:-1]]
                for r, item in zip(row["row"], row["item"], strict=True):
                    items.setdefault(r, set()).add(item)
            none = hashlib.sha256(b"").hexdigest()
            sha = [hashlib.sha256(",".join(sorted(items[r])).encode()).hexdigest() if r in items else none for r in range(len(ids))]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.diff(off)), pa.array(hit, pa.int64()), pa.array([len(items.get(r, ())) for r in range(len(ids))], pa.int64()), pa.array(sha), pa.array(hit > 0)],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def _hits(packed: DataFrame, chunks: list[DataFrame], window: int, buckets: int, vocabulary: np.ndarray | None, work: Scratch) -> tuple[DataFrame, DataFrame | None]:
    """The index (of the last chunk, if each has one; all have the same documents) and the spans hit by any chunk."""
    index = build_index(packed, np.zeros(0, np.uint64) if vocabulary is None else vocabulary, buckets, work) if vocabulary is not None or not chunks else None
    hits = None
    for items in chunks:
        phrases = Phrases(items, window, vocabulary)
        if vocabulary is None:
            index = build_index(packed, phrases.vocabulary, buckets, work)
        some = _search(index, phrases)
        hits = some if hits is None else hits.unionByName(work.keep(some, "hits"))
    return index, hits


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, scope: str | None = None) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each document."""
    work = Scratch(docs.sparkSession, scope)
    chunks, rows = _chunks(benchmark.select("item_id", "text")), _texts(docs)
    vocabulary, buckets = shared_vocabulary(benchmark), B.bucket_count(rows)
    # Several indexes must see the same rows in the same blocks.
    packed = B.pack(rows) if vocabulary is not None else B.store(rows, work, "decontaminate-blocks")
    index, hits = _hits(packed, chunks, window, buckets, vocabulary, work)
    meta = index.select("block", "doc_id", "word_off")
    meta._fundlake_buckets = buckets
    if hits is None:
        empty = "array<long>"
        full = meta.select("*", F.lit(None).cast(empty).alias("row"), F.lit(None).cast("array<string>").alias("item"), F.lit(None).cast(empty).alias("start"), F.lit(None).cast(empty).alias("end"))
    else:
        full = B.reply(meta, hits, row="row", item="item", start="start", end="end")
    return full.mapInArrow(_report, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def proximity(docs: DataFrame, terms: list[str], within: int) -> DataFrame:
    """doc_id and word position of the rarest term, wherever all other terms stand within so many words of it."""
    words = words_of(pa.array(terms, pa.string()), lower=True, parts=NOT_ALNUM)
    vocabulary, numbers = np.unique(words.hashes(), return_inverse=True)
    index = build_index(B.pack(_texts(docs)), vocabulary, B.bucket_count(docs), Scratch(docs.sparkSession))
    rarity = frequencies(index, len(vocabulary))
    wanted = [int(x) for x in dict.fromkeys(numbers[np.argsort(rarity[numbers], kind="stable")].tolist())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                segment, ids = Segment(row), B.decode(row["doc_id"])["doc_id"].combine_chunks()
                at = segment.near(wanted, within) if wanted else np.zeros(0, _I32)
                doc = segment.docs(at)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(doc, pa.int64())), pa.array(at - segment.word_off[doc], pa.int64())], names=["doc_id", "position"])

    return index.mapInArrow(run, "doc_id long, position long")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, scope: str | None = None) -> DataFrame:
    """docs without the rows that hold any benchmark window; all columns pass unchanged."""
    work = Scratch(docs.sparkSession, scope)
    chunks = _chunks(benchmark.select("item_id", "text"))
    if not chunks:
        return docs
    packed = B.store(docs, work, "decontaminate-blocks")
    _, hits = _hits(packed, chunks, window, packed._fundlake_buckets, shared_vocabulary(benchmark), work)

    def run(block: int, table: pa.Table, row: pa.Scalar) -> Iterator[pa.RecordBatch]:
        clean = np.ones(table.num_rows, bool)
        clean[row.as_py() or []] = False
        yield from table.filter(pa.array(clean)).combine_chunks().to_batches()

    return B.each(B.reply(packed, hits.select("block", "row").distinct(), row="row"), run, docs.schema)
