"""Language-model scores by context-tree weighting over bytes.

A text's tokens are its words, lower-cased, and one end. Its byte string is the
words joined by spaces and ended by a newline. Each byte is eight binary
decisions; a decision's context is the bits of the byte so far and up to
``DEPTH`` bytes before it. Every node of this tree of contexts has a
Krichevsky-Trofimov estimate of its decision, and context-tree weighting mixes
the estimates of all depths: with Pe a node's own block probability and Pw that
of its subtree, Pw = (Pe + product of the children's Pw) / 2, so a node's own
estimate has the weight Pe / (2 Pw) and its children the rest.

1. Each block lists its distinct bytes with their contexts and how often its
   training texts have them, dealt to buckets of whole subtrees from ``ROOT`` down.
2. A bucket sums its blocks' counts and weighs its subtrees, bottom up; one task
   weighs the few nodes above; then, top down, each node gets the mixture's
   probability if the path ends there.
3. A byte is scored decision by decision at the deepest node its context has: a
   proper distribution over all texts. Every listed byte has its own place in
   its bucket's tree (with a count of 0 if no training text has it), so no node
   is dropped and none is taken for another; the bucket answers each block.

All of this grows with the text; what is broadcast are the nodes above ``ROOT``
for the contexts that occur.

The base score is that of smoothed word counts; they are summed over the corpus
by word and asked for by block and distinct word.

Edge cases: null and empty texts are one end token. Rows that repeat count each.
A null doc_id is neither learnt from nor held out; it is scored. With no
training texts all counts are 0 and each byte costs 8 bits.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.llm import blocks as B
from fundlake.llm.scratch import Scratch
from fundlake.llm.tokens import U64, Words, mix, words_of

DEPTH, ROOT = 6, 3
#: Bytes of text of a block: the more, the fewer times a context is listed.
BLOCK = 16 << 20
#: Bytes of text looked at together.
_PIECE = 1 << 19
#: Bytes of text for each bucket of subtrees, and the most buckets.
BUCKET, MOST_BUCKETS = 32 << 20, 1 << 14
#: Listed contexts held before the counts of equal ones are summed.
HELD = 500_000
_END, _BLANK = 10, 32
_LOG_2 = math.log10(2)


def byte_string(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all documents (words joined by a space, a newline at the end), and where each begins."""
    n = len(words.off) - 1
    count = np.diff(words.off)
    length = words.end - words.start + 1  # with what follows the word
    first = np.cumsum(length) - length
    doc = np.repeat(np.arange(n), count)
    empty = (count == 0).astype(np.int64)
    shift = np.cumsum(empty)  # an empty text is a newline by itself
    total = int(length.sum() + empty.sum())
    out = np.full(total, _END, dtype=np.uint8)
    at = first + shift[doc]
    source = np.arange(int(length.sum())) + np.repeat(words.start - first, length)
    target = np.arange(int(length.sum())) + np.repeat(shift[doc], length)
    out[target] = words.data[np.minimum(source, max(len(words.data) - 1, 0))] if len(source) else 0
    out[at + length - 1] = _BLANK
    size = np.bincount(doc, length, n).astype(np.int64) + empty
    off = np.concatenate([[0], np.cumsum(size)])
    out[off[1:] - 1] = _END
    return out, off


def grams(data: np.ndarray, off: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Each byte with the depth bytes before it, the byte itself lowest; before a text stand newlines."""
    into = np.arange(len(data)) - np.repeat(off[:-1], np.diff(off))
    code = data.astype(U64)
    for j in range(1, depth + 1):
        before = np.full(len(data), _END, dtype=U64)
        before[j:] = data[:-j] if j < len(data) else []
        before[into < j] = _END
        code |= before << U64(8 * j)
    return code


def log_gamma(x: np.ndarray) -> np.ndarray:
    y = x + 8.0
    shift = np.log(x)
    for k in range(1, 8):
        shift = shift + np.log(x + k)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def _log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1.0) - math.log(math.pi)


_SMALL = _log_kt(*(x.astype(float) for x in np.indices((64, 64))))


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log block probability of the Krichevsky-Trofimov estimator for whole counts."""
    out = _SMALL[np.minimum(n0, 63).astype(np.int64), np.minimum(n1, 63).astype(np.int64)]
    big = (n0 > 63) | (n1 > 63)
    out[big] = _log_kt(n0[big], n1[big])
    return out


def _cut(code: np.ndarray, depth: int) -> np.ndarray:
    """Bytes with only so many bytes of context: the oldest go."""
    return code & U64((1 << (8 * depth + 8)) - 1)


class Decision:
    """The nodes of one of a byte's decisions at one depth: which node each byte is at, and the node's counts."""

    __slots__ = ("of", "first", "n0", "n1", "pw", "weight", "ends", "held", "left")

    def __init__(self, code: np.ndarray, count: np.ndarray, k: int):
        prefix = code >> U64(8 - k)
        new = np.r_[True, prefix[1:] != prefix[:-1]] if len(code) else np.zeros(0, bool)
        self.first = np.flatnonzero(new)
        self.of = np.cumsum(new) - 1
        one = ((code >> U64(7 - k)) & U64(1)).astype(float)
        self.n1 = np.bincount(self.of, count * one, len(self.first))
        self.n0 = np.bincount(self.of, count, len(self.first)) - self.n1

    def weigh(self, children: np.ndarray | None) -> None:
        """Log Pw from the children's summed log Pw; a node at the deepest level has none."""
        own = log_kt(self.n0, self.n1)
        if children is None:
            self.pw, self.weight = own, np.ones(len(own))
        else:
            self.pw = math.log(0.5) + np.logaddexp(own, children)
            self.weight = np.exp(own + math.log(0.5) - self.pw)

    def mix(self, ends: np.ndarray | None, held: np.ndarray, left: np.ndarray) -> None:
        """P(1) if the path ends here, what is mixed so far and the weight left, from those of the parents (ends: None above all).

        A node that no training text has ends where its parent does."""
        n = self.n0 + self.n1
        kt = (self.n1 + 0.5) / (n + 1.0)
        self.ends = held + left * kt
        if ends is not None:
            self.ends = np.where(n > 0, self.ends, ends)
        self.held, self.left = held + left * self.weight * kt, left * (1 - self.weight)


class Tree:
    """Distinct bytes in context at depths top..deepest, as whole subtrees."""

    def __init__(self, code: np.ndarray, count: np.ndarray, top: int, deepest: int):
        self.top, self.deepest = top, deepest
        self.code, self.count, self.up = {deepest: code}, {deepest: count.astype(float)}, {}
        for d in range(deepest, top, -1):
            self.code[d - 1], self.up[d] = np.unique(_cut(self.code[d], d - 1), return_inverse=True)
            self.count[d - 1] = np.bincount(self.up[d], self.count[d], len(self.code[d - 1]))

    def weigh(self, k: int, below: np.ndarray | None = None) -> dict[int, Decision]:
        """Decision k of all levels, weighed bottom up; below: log Pw of what is under the deepest nodes, if the tree goes on elsewhere."""
        at = {}
        for d in range(self.deepest, self.top - 1, -1):
            at[d] = Decision(self.code[d], self.count[d], k)
            at[d].weigh(below if d == self.deepest else np.bincount(self.parents(at, d + 1), at[d + 1].pw, len(at[d].first)))
        return at

    def parents(self, at: dict[int, Decision], d: int) -> np.ndarray:
        """The node one byte of context shorter, for each node of a level."""
        return at[d - 1].of[self.up[d][at[d].first]]

    def mix(self, at: dict[int, Decision], ends: np.ndarray | None, held: np.ndarray, left: np.ndarray) -> Decision:
        """Mixtures top down, given those of the top nodes' parents; the deepest level's."""
        at[self.top].mix(ends, held, left)
        for d in range(self.top + 1, self.deepest + 1):
            up = self.parents(at, d)
            at[d].mix(at[d - 1].ends[up], at[d - 1].held[up], at[d - 1].left[up])
        return at[self.deepest]


def _key(code: np.ndarray, k: int) -> np.ndarray:
    """A node's name: context, then the bits so far with a leading 1."""
    return code >> U64(8) << U64(8) | U64(1 << k) | (code & U64(0xFF)) >> U64(8 - k)


class Above:
    """The nodes above ROOT: for each decision the names of the lowest ones and their mixtures."""

    def __init__(self, code: np.ndarray, count: np.ndarray, key: np.ndarray, pw: np.ndarray):
        """code, count: distinct bytes with ROOT - 1 bytes of context; key, pw: summed log Pw of the children of each lowest node."""
        tree, self.at = Tree(code, count, 0, ROOT - 1), []
        for k in range(8 if len(code) else 0):
            low = Decision(code, tree.count[ROOT - 1], k)
            keys = _key(code[low.first], k)
            at = tree.weigh(k, pw[np.searchsorted(key, keys)])
            n = len(at[0].first)
            x = tree.mix(at, None, np.zeros(n), np.ones(n))
            self.at.append((keys, x.ends, x.held, x.left))

    def of(self, key: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, *values = self.at[k]
        at = np.searchsorted(keys, key)
        return tuple(x[at] for x in values)


def log2(code: np.ndarray, count: np.ndarray, above: Above) -> np.ndarray:
    """Log2 probability of each distinct byte of a bucket in its context."""
    tree, out = Tree(code, count, ROOT, DEPTH), np.zeros(len(code))
    for k in range(8 if len(code) else 0):
        at = tree.weigh(k)
        x = tree.mix(at, *above.of(_key(_cut(tree.code[ROOT][at[ROOT].first], ROOT - 1), k), k))
        p = x.ends[x.of]
        out += np.log2(np.where((code >> U64(7 - k)) & U64(1) == 1, p, 1 - p))
    return out


def train_rows(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, mod 5; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def _pieces(table: pa.Table) -> Iterator[pa.Table]:
    """A table in runs of rows of about _PIECE bytes of text; one longer text is a run of its own."""
    size = np.cumsum(pc.coalesce(pc.binary_length(table["text"].combine_chunks()), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(size):
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + _PIECE)))
        yield table.slice(at, end - at)
        at = end


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(codes)
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


def _folded(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of all parts; of those that come, only so many are held."""
    kept, held = [(np.zeros(0, U64), np.zeros(0, np.int64))], 0
    for part in parts:
        kept.append(part)
        held += len(part[0])
        if held > HELD:
            kept, held = [_summed(kept)], 0
    return _summed(kept)


def _list(buckets: int) -> Callable[..., Iterator[pa.RecordBatch]]:
    """Of a block, for each bucket: its distinct grams, and how often its training texts have them."""

    def run(block: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for piece in _pieces(table):
                text, off = byte_string(words_of(piece["text"], lower=True))
                learn = np.repeat(piece["learn"].to_numpy(), np.diff(off)).astype(U64)
                seen, n = np.unique(grams(text, off) << U64(1) | learn, return_counts=True)
                yield seen >> U64(1), np.where(seen & U64(1) == 1, n, 0)

        code, n = _folded(found())
        if not len(code):
            return
        bucket = (mix((code >> U64(8)) & U64((1 << (8 * ROOT)) - 1)) % U64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        code, n, bucket = code[order], n[order], bucket[order]
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        spans = list(zip(first, np.r_[first[1:], len(bucket)], strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[first]), pa.array(np.full(len(first), block)), pa.array([_squeeze(code[i:j], n[i:j]) for i, j in spans], pa.binary()), pa.array([int(j - i) for i, j in spans], pa.int64())],
            names=["bucket", "block", "listed", "size"],
        )

    return run


def _squeeze(code: np.ndarray, n: np.ndarray) -> bytes:
    return pa.compress(np.concatenate([np.diff(code, prepend=U64(0)), n.astype(U64)]).tobytes(), "zstd", asbytes=True)


def _listed(payload: pa.Scalar, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams in order, and their counts."""
    both = np.frombuffer(pa.decompress(payload.as_buffer(), 16 * size, "zstd"), U64)
    return np.cumsum(both[:size], dtype=U64), both[size:].astype(np.int64)


def _pack_bits(bits: np.ndarray) -> bytes:
    """Log2 probabilities to 34 places after the binary point, in five bytes each."""
    fixed = np.rint(bits * -(2.0**34)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
    return pa.compress(np.ascontiguousarray(fixed.T).tobytes(), "zstd", asbytes=True)


def _unpack_bits(payload: pa.Scalar, size: int) -> np.ndarray:
    fixed = np.zeros((size, 8), np.uint8)
    fixed[:, :5] = np.frombuffer(pa.decompress(payload.as_buffer(), 5 * size, "zstd"), np.uint8).reshape(5, size).T
    return fixed.view("<u8")[:, 0] * -(2.0**-34)


def _of_bucket(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A bucket's distinct grams, and how often all training texts have them (0 if only others do)."""
    return _folded(_listed(payload, size) for payload, size in zip(rows["listed"], rows["size"].to_pylist(), strict=True))


def _above(rows: pa.Table) -> pa.Table:
    """For a bucket of subtrees: bytes after ROOT - 1 bytes with their counts (short), and log Pw at depth ROOT summed by parent."""
    code, count = _of_bucket(rows)
    tree = Tree(code, count, ROOT, DEPTH)
    short, into = np.unique(_cut(tree.code[ROOT], ROOT - 1), return_inverse=True)
    keys, sums = [], []
    for k in range(8):
        root = tree.weigh(k)[ROOT]
        parent, of = np.unique(_key(_cut(tree.code[ROOT][root.first], ROOT - 1), k), return_inverse=True)
        keys.append(parent)
        sums.append(np.bincount(of, root.pw, len(parent)))
    B.trim()
    more = sum(map(len, keys))
    return pa.table({
        "short": np.repeat([True, False], [len(short), more]),
        "code": np.concatenate([short, *keys]).view(np.int64),
        "x": np.concatenate([np.bincount(into, tree.count[ROOT], len(short)), *sums]),
    })


def _top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = pa.Table.from_batches(list(batches), schema=pa.schema([("short", pa.bool_()), ("code", pa.int64()), ("x", pa.float64())]))
    parts = []
    for part in (rows.filter(rows["short"]), rows.filter(pc.invert(rows["short"]))):
        code, x = part["code"].to_numpy().view(U64), part["x"].to_numpy()
        order = np.argsort(code)
        parts += [code[order], x[order]]
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(Above(*parts))], pa.binary())], names=["above"])


def answer(packed: DataFrame, buckets: int, work: Scratch) -> DataFrame:
    """(block, listed, size, bits): the grams of a block, by bucket, and their log2 probabilities by the model of all rows that are marked learn."""
    spark = packed.sparkSession
    listed = work.keep(B.each(packed, _list(buckets), "bucket long, block long, listed binary, size long"), "grams")
    sums = listed.groupBy("bucket").applyInArrow(_above, "short boolean, code long, x double").groupBy("short", "code").agg(F.sum("x").alias("x"))
    # At most 256 ** ROOT bytes in context, in truth as many as the languages have: thousands.
    made = sums.repartition(1).mapInArrow(_top, "above binary").first()
    above = spark.sparkContext.broadcast(bytes(made.above) if made else b"")  # no rows, no buckets that ask
    work.sweep()  # first pass

    def mixed(rows: pa.Table) -> pa.Table:
        code, count = _of_bucket(rows)
        bits = log2(code, count, pickle.loads(above.value))
        found = [_pack_bits(bits[np.searchsorted(code, _listed(payload, size)[0])]) for payload, size in zip(rows["listed"], rows["size"].to_pylist(), strict=True)]
        B.trim()
        return rows.select(["block", "listed", "size"]).append_column("bits", pa.array(found, pa.binary()))

    return listed.groupBy("bucket").applyInArrow(mixed, "block long, listed binary, size long, bits binary")


def _ask(block: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Distinct words of a block and how often its training texts have them."""

    def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for piece in _pieces(table):
            words = words_of(piece["text"], lower=True)
            h, inverse = np.unique(words.hashes(), return_inverse=True)
            yield h, np.bincount(inverse[piece["learn"].to_numpy()[words.docs()]], minlength=len(h)).astype(np.int64)

    h, n = _folded(found())
    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.full(len(h), block)), pa.array(n)], names=["h", "block", "n"])


def _known(answers: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    """A block's grams in order and the log2 probability of each."""
    rows = answers.values
    size = rows.field("size").to_pylist()
    code = np.concatenate([_listed(x, n)[0] for x, n in zip(rows.field("listed"), size, strict=True)])
    order = np.argsort(code)
    code = code[order]
    bits = np.concatenate([_unpack_bits(x, n) for x, n in zip(rows.field("bits"), size, strict=True)])[order]
    return code, bits


def score(docs: DataFrame, held_out: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte for each document."""
    spark = docs.sparkSession
    work = Scratch(spark)
    fold = train_rows()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held", F.coalesce(fold == held_out, F.lit(False))).withColumn("learn", F.coalesce(fold != held_out, F.lit(False)))
    seen = rows.agg(F.count_if("learn").alias("ends"), F.sum(F.octet_length("text")).alias("bytes")).first()
    packed = B.store(rows, work, "lm-blocks", BLOCK)
    ends, buckets = seen.ends, max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(MOST_BUCKETS, (seen.bytes or 0) // BUCKET))
    asked = B.totals(B.each(packed, _ask, "h long, block long, n long"), packed, ["h"], c="sum(n)", lead="min(block)").where("c > 0")
    answers = work.keep(asked.groupBy("block").agg(F.collect_list("h").alias("h"), F.collect_list("c").alias("c"), F.sum("n").alias("tokens"), F.sum((F.col("block") == F.col("lead")).cast("long")).alias("kinds")), "lm-words")
    total = answers.agg(F.sum("tokens").alias("n"), F.sum("kinds").alias("v")).first()
    n, v = (total.n or 0) + ends, (total.v or 0) + (ends > 0)
    work.sweep()  # words
    # One join brings a block both kinds of answers.
    words = answers.select("block", F.lit(None).cast("struct<listed: binary, size: bigint, bits: binary>").alias("x"), "h", "c")
    bytes_ = answer(packed, buckets, work).select("block", F.struct("listed", "size", "bits").alias("x"), F.lit(None).cast("array<bigint>").alias("h"), F.lit(None).cast("array<bigint>").alias("c"))
    answered = words.unionByName(bytes_).repartition(packed._fundlake_buckets, "block").groupBy("block").agg(F.collect_list("x").alias("answers"), F.flatten(F.collect_list("h")).alias("h"), F.flatten(F.collect_list("c")).alias("c"))
    log_n = math.log10(n + 0.5 * (v + 1))

    def run(block: int, table: pa.Table, h: pa.Scalar, c: pa.Scalar, answers: pa.Scalar) -> Iterator[pa.RecordBatch]:
        keys, values = h.values.to_numpy(zero_copy_only=False).view(U64), c.values.to_numpy(zero_copy_only=False)
        order = np.argsort(keys)
        keys, values = keys[order], values[order]
        codes, logs = _known(answers)
        for piece in _pieces(table):
            words = words_of(piece["text"], lower=True)
            of, count = words.docs(), piece.num_rows
            known = np.zeros(len(of), np.int64)
            if len(keys) and len(of):
                mine = words.hashes()
                at = np.minimum(np.searchsorted(keys, mine), len(keys) - 1)
                known = np.where(keys[at] == mine, values[at], 0)
            tokens = words.counts() + 1
            base = np.bincount(of, np.log10(known + 0.5), count) + math.log10(ends + 0.5) - tokens * log_n
            text, off = byte_string(words)
            distinct, inverse = np.unique(grams(text, off), return_inverse=True)
            bits = np.add.reduceat(logs[np.searchsorted(codes, distinct)][inverse], off[:-1])
            yield pa.RecordBatch.from_arrays(
                [piece["doc_id"].combine_chunks(), piece["held"].combine_chunks(), pa.array(tokens.astype(np.int64)), pa.array(np.bincount(of[known > 0], minlength=count) + int(ends > 0), pa.int64()), pa.array(np.full(count, n), pa.int64()), pa.array(base), pa.array(bits * _LOG_2), pa.array(-bits / np.diff(off))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"],
            )

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    return B.each(packed.join(answered.hint("merge"), "block"), run, schema)
