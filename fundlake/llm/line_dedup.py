"""Line dedup by a sharded minimal perfect hash.

Distinct line hashes that stand in two or more documents are dealt to shards.
Each shard builds a minimal perfect hash (levels of bit arrays; a key's index
is the rank of its bit) over its hashes and beside it three plain arrays:
fingerprint, document count and the document that keeps the line. Documents
then probe these arrays with the hashes of their own lines, block by block;
lines are never joined, and no line's text leaves its document.

Rules (``dedup_lines``): a text is split at ``\\n``; a line's key is the line
stripped of ASCII white space at both ends, with A-Z lower-cased. A key of at
least ``min_chars`` code points that stands in at least ``min_docs`` documents
loses all its lines, except in the document with the largest id that holds it.

Lines are told apart by 128 bits: a hash of 64 that is looked up and a
fingerprint of 64 that is compared.

Edge cases: a null or empty text is one empty line. Rows with the same doc_id
count as documents of their own but keep or lose a line together. A null
doc_id is smaller than any other; if all holders of a line have null ids, all
keep it. An empty table gives an empty result. Other columns pass unchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlake.llm import blocks as B
from fundlake.llm.scratch import Scratch
from fundlake.llm.tokens import U64, mix

MIN_CHARS, MIN_DOCS = 40, 5
#: Probes of one shard, about; it fixes how many shards there are.
SHARD_PROBES = 200_000
_NO_ID = np.iinfo(np.int64).min


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: level after level, keys alone at their position claim its bit."""

    GAMMA = 1.7

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, total = [], 0
        for words in levels:
            ones = np.bitwise_count(words).astype(np.int64)
            self.ranks.append(total + np.cumsum(ones) - ones)
            total += int(ones.sum())
        self.n = total

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], np.unique(keys)  # equal keys would never be alone
        while len(left):
            size = max(1, int(len(left) * cls.GAMMA) // 64 + 1)
            at = cls._place(left, len(levels), size)
            counts = np.bincount(at, minlength=size * 64)
            alone = counts[at] == 1
            bits = np.packbits(counts == 1, bitorder="little").view(U64)
            levels.append(bits)
            left = left[~alone]
        return cls(levels)

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + U64(level * 0xA24BAED4963EE407 % (1 << 64))) % U64(size * 64)).astype(np.int64)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key; of a key that isn't in the set, any index or -1."""
        out, open_ = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys))
        for level, (words, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            if not len(open_):
                break
            at = self._place(keys[open_], level, len(words))
            word, bit = words[at >> 6], (at & 63).astype(U64)
            hit = (word >> bit) & U64(1) == 1
            below = np.bitwise_count(word & ((U64(1) << bit) - U64(1))).astype(np.int64)
            out[open_[hit]] = (ranks[at >> 6] + below)[hit]
            open_ = open_[~hit]
        return out

    def dump(self) -> bytes:
        return np.array([len(self.levels), *map(len, self.levels)], dtype=U64).tobytes() + b"".join(x.tobytes() for x in self.levels)

    @classmethod
    def load(cls, raw: bytes) -> PerfectHash:
        all_ = np.frombuffer(raw, dtype=U64)
        n = int(all_[0])
        ends = np.cumsum(all_[1 : n + 1].astype(np.int64)) + n + 1
        return cls([all_[e - int(size) : e] for e, size in zip(ends, all_[1 : n + 1], strict=True)])


def _keys(text: str | None, min_chars: int) -> tuple[list[str], list[tuple[int, int] | None]]:
    """Lines of a text, and for each the two hashes of its key, or None for keys that are too short."""
    lines, keys = (text or "").split("\n"), []
    for line in lines:
        if len(line) < min_chars:
            keys.append(None)
            continue
        key = line.strip(" \t\n\r\x0b\x0c")
        if len(key) < min_chars:
            keys.append(None)
            continue
        h = xxhash.xxh3_128_intdigest(key.encode("utf-8", "surrogatepass").lower())
        keys.append(((h >> 64) - (1 << 63), (h & 0xFFFFFFFFFFFFFFFF) - (1 << 63)))
    return lines, keys


def _requests(min_chars: int):
    def run(block: int, docs: pa.Table) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[int]] = {}
        for doc, text in zip(docs["doc_id"].to_pylist(), docs["text"].to_pylist(), strict=True):
            doc = _NO_ID if doc is None else doc
            for key in {k for k in _keys(text, min_chars)[1] if k}:
                if key in held:
                    x = held[key]
                    x[0] += 1
                    x[1] = max(x[1], doc)
                else:
                    held[key] = [1, doc]
        n = len(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in held], pa.int64()), pa.array([k[1] for k in held], pa.int64()), pa.array([block] * n, pa.int64()), pa.array([x[0] for x in held.values()], pa.int64()), pa.array([x[1] for x in held.values()], pa.int64())],
            names=["h", "fp", "block", "docs", "keeper"],
        )

    return run


def _index(rows: pa.Table) -> pa.Table:
    """The arrays of one shard: entries in the order of their hash's index, and where each index's entries begin.

    Lines whose first hashes are equal have one index and an entry each, told apart by the fingerprint."""
    keys = rows["h"].to_numpy().view(U64)
    table = PerfectHash.build(keys)
    at = table.index(keys)
    order = np.argsort(at, kind="stable")
    arrays = [np.searchsorted(at[order], np.arange(table.n + 1)), *[rows[x].to_numpy()[order] for x in ("fp", "docs", "keeper")]]
    return pa.table([rows["shard"].slice(0, 1).cast(pa.int64()), pa.array([table.dump()], pa.binary()), *[pa.array([x.astype(np.int64).tobytes()], pa.binary()) for x in arrays]], names=["shard", "hash", "start", "fp", "docs", "keeper"])


def _probe(min_docs: int):
    def run(probes: pa.Table, shard: pa.Table) -> pa.Table:
        h, fp = probes["h"].to_numpy(), probes["fp"].to_numpy()
        if not len(h) or not shard.num_rows:
            return pa.table([pa.array([], pa.int64())] * 4, names=["block", "h", "fp", "keeper"])
        start, fps, docs, keeper = (np.frombuffer(shard[x][0].as_buffer(), dtype=np.int64) for x in ("start", "fp", "docs", "keeper"))
        index = PerfectHash.load(shard["hash"][0].as_buffer()).index(h.view(U64))
        known = np.flatnonzero(index >= 0)
        at, end = start[index[known]], start[index[known] + 1]
        probe, entry = [], []
        while len(known):  # once, but for lines whose first hashes are equal
            hit = fps[at] == fp[known]
            probe.append(known[hit])
            entry.append(at[hit])
            more = ~hit & (at + 1 < end)
            known, at, end = known[more], at[more] + 1, end[more]
        probe, entry = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (probe, entry))
        hot = docs[entry] >= min_docs
        probe, entry = probe[hot], entry[hot]
        return pa.table([probes["block"].to_numpy()[probe], h[probe], fp[probe], keeper[entry]], names=["block", "h", "fp", "keeper"])

    return run


def _drops(docs: DataFrame, min_chars: int, min_docs: int, work: Scratch) -> DataFrame:
    """Blocks of docs with the keys (both hashes) that lose their lines there and the documents that keep them."""
    packed = B.store(docs, work, "line-blocks")
    requests = work.keep(B.each(packed, _requests(min_chars), "h long, fp long, block long, docs long, keeper long"), "line-requests")
    shards = max(1, -(-requests.count() // SHARD_PROBES), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shard = F.pmod(F.xxhash64("h"), F.lit(shards))
    entries = requests.groupBy("h", "fp").agg(F.sum("docs").alias("docs"), F.max("keeper").alias("keeper")).where("docs >= 2")
    index = entries.withColumn("shard", shard).groupBy("shard").applyInArrow(_index, "shard long, hash binary, start binary, fp binary, docs binary, keeper binary")
    probes = requests.select(shard.alias("shard"), "h", "fp", "block")
    answers = probes.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(_probe(min_docs), "block long, h long, fp long, keeper long")
    return B.reply(packed, answers, h="h", fp="fp", keeper="keeper")


def _kept(docs: pa.Table, h: pa.Scalar, fp: pa.Scalar, keeper: pa.Scalar, min_chars: int) -> Iterator[tuple[int, list[str], int]]:
    """For each document: its number of lines, the lines that stay, how many are dropped."""
    losing = dict(zip(zip(h.as_py() or (), fp.as_py() or (), strict=True), keeper.as_py() or (), strict=True))
    for doc, text in zip(docs["doc_id"].to_pylist(), docs["text"].to_pylist(), strict=True):
        if not losing:
            lines = (text or "").split("\n")
            yield len(lines), lines, 0
            continue
        doc = _NO_ID if doc is None else doc
        lines, keys = _keys(text, min_chars)
        stay = [x for x, k in zip(lines, keys, strict=True) if k is None or losing.get(k, doc) == doc]
        yield len(lines), stay, len(lines) - len(stay)


def line_report(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, n_lines (before), n_dropped, kept_sha256 of the text that is left."""
    work = Scratch(docs.sparkSession)

    def run(block: int, table: pa.Table, h: pa.Scalar, fp: pa.Scalar, keeper: pa.Scalar) -> Iterator[pa.RecordBatch]:
        n, dropped, sha = [], [], []
        for lines, stay, lost in _kept(table, h, fp, keeper, min_chars):
            n.append(lines)
            dropped.append(lost)
            sha.append(hashlib.sha256("\n".join(stay).encode("utf-8", "surrogatepass")).hexdigest())
        ids = table["doc_id"].combine_chunks().cast(pa.int64())
        yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(sha, pa.string())], names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    blocks = _drops(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), min_chars, min_docs, work)
    return B.each(blocks, run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, scope: str | None = None) -> DataFrame:
    """docs with the repeated lines taken out of text; n_chars, if there, follows the text."""
    work = Scratch(docs.sparkSession, scope)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema.fields])

    def run(block: int, table: pa.Table, h: pa.Scalar, fp: pa.Scalar, keeper: pa.Scalar) -> Iterator[pa.RecordBatch]:
        if h.is_valid:
            at = table.schema.get_field_index("text")
            kept = list(_kept(table, h, fp, keeper, min_chars))
            old = table["text"].to_pylist()
            texts = [o if not lost else "\n".join(stay) for o, (_, stay, lost) in zip(old, kept, strict=True)]
            kind = table.schema.field("text").type
            table = table.set_column(at, "text", pa.array(texts, kind))
            if "n_chars" in table.schema.names:
                was = table["n_chars"].to_pylist()
                now = [w if not lost else len(t) for w, t, (_, _, lost) in zip(was, texts, kept, strict=True)]
                table = table.set_column(table.schema.get_field_index("n_chars"), "n_chars", pa.array(now, table.schema.field("n_chars").type))
        yield from table.combine_chunks().to_batches()

    return B.each(_drops(docs, min_chars, min_docs, work), run, schema)
