"""Quality classifier: votes of the nearest labelled documents.

A document becomes counts of its words (lower-cased, hashed), counts of the
shapes of its text (pairs and hashed triples of character classes, such as
upper-case letters or one punctuation mark) and a few rates (repeated words,
distinct words, word length). A latent-semantic basis is fitted to the labelled
sample: log counts weighed by rarity, the rates in units of their spread, and
the leading singular directions of all. Sample vectors and basis are broadcast;
every document's cosine with every sample vector is computed in blocks, and its
``NEIGHBOURS`` nearest vote with weights that grow with the similarity.

Labels are learnt from a sample of at most ``MAX_SAMPLE`` labelled documents
whose crc32(doc_id as text) mod 5 is not 0, the first in the order of a hash,
so what is broadcast is bounded (``MAX_SAMPLE`` x ``DIMS`` numbers and the
basis); all documents are scored. The basis is fitted in one task on executors
from the sample's features; the driver passes on no more than the fitted
numbers. Language, source, id and labels are no inputs of a score.

Edge cases: null and empty texts have a vector of their own (no counts, rates
of nothing) and get a score like any other. If no labels remain, the score is
0.5. Rows that repeat get equal scores; a doc_id with several labels votes with
each; of rows that share a labelled doc_id the one whose text hashes lowest is
learnt from. Sample vectors as similar (to six digits) as the last that votes
vote too. A null doc_id is not held out, has no label and is scored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlake.llm.scratch import tune
from fundlake.llm.tokens import LOWER, U64, Words, words_of

MAX_SAMPLE, DIMS, NEIGHBOURS, THRESHOLD = 4000, 48, 15, 0.3
#: Similarity is raised to this power for a vote's weight.
SHARPNESS = 8.0
_TRIPLES, _WORDS = 2048, 4096
#: Weight of a word's count beside those of shapes.
_WORD_WEIGHT = 0.5
_PASS_DOCS = 512


def _classes() -> tuple[np.ndarray, int]:
    """Byte -> class: lower, upper, digit, non-ASCII, white space but newline, controls; any other byte is its own class."""
    out, n = np.zeros(256, dtype=np.int64), 6
    for b in range(256):
        c = chr(b)
        if b >= 128:
            out[b] = 3
        elif "a" <= c <= "z":
            out[b] = 0
        elif "A" <= c <= "Z":
            out[b] = 1
        elif "0" <= c <= "9":
            out[b] = 2
        elif c in " \t":
            out[b] = 4
        elif b < 32 and c != "\n" or b == 127:
            out[b] = 5
        else:
            out[b], n = n, n + 1
    return out, n


_CLASS, _N = _classes()
RATES = 10
WIDTH = _N * _N + _TRIPLES + _WORDS + RATES


def features(column: pa.Array) -> np.ndarray:
    """One row a document: log counts of class pairs, triples and words, then rates."""
    words = words_of(column)
    n, size = len(words.off) - 1, np.diff(words.doc_off)
    c = _CLASS[words.data]
    doc = np.repeat(np.arange(n), size)
    out = np.zeros((n, WIDTH), dtype=np.float32)
    for k, width, at in ((2, _N * _N, 0), (3, _TRIPLES, _N * _N)):
        if len(c) >= k:
            code = c[: len(c) - k + 1].copy()
            for j in range(1, k):
                code = code * _N + c[j : len(c) - k + 1 + j]
            if k == 3:
                code = ((code * 0x9E3779B1) >> 7) % width
            same = doc[: len(code)] == doc[k - 1 :]
            out[:, at : at + width] = np.log1p(np.bincount((doc[: len(code)] * width + code)[same], minlength=n * width).reshape(n, width))
    h, count = words.hashes(), words.counts()
    wdoc = words.docs()
    terms = Words(LOWER[words.data], words.doc_off).hashes()
    out[:, _N * _N + _TRIPLES : -RATES] = _WORD_WEIGHT * np.log1p(np.bincount(wdoc * _WORDS + (terms % U64(_WORDS)).astype(np.int64), minlength=n * _WORDS).reshape(n, _WORDS))
    per = lambda mask, d: np.bincount(d[mask], minlength=n)
    many, chars = np.maximum(count, 1), np.maximum(size, 1)
    again = np.r_[False, (h[1:] == h[:-1]) & (wdoc[1:] == wdoc[:-1])] if len(h) else np.zeros(0, bool)
    order = np.lexsort((h, wdoc))
    known = np.r_[False, (h[order][1:] == h[order][:-1]) & (wdoc[order][1:] == wdoc[order][:-1])] if len(h) else np.zeros(0, bool)
    rates = [per(again, wdoc) / many, per(known, wdoc[order]) / many, np.bincount(wdoc, words.end - words.start, n) / many / 10]
    rates += [per(c == k, doc) / chars for k in (1, 2, 3, 4)]
    rates += [per(c > 5, doc) / chars, np.log1p(count) / 10, np.log1p(per(words.data == 10, doc)) / 10]
    out[:, -RATES:] = np.stack(rates, axis=1)
    return out


class Basis:
    """What turns features into latent-semantic vectors of unit length."""

    def __init__(self, idf: np.ndarray, centre: np.ndarray, spread: np.ndarray, mean: np.ndarray, v: np.ndarray):
        self.idf, self.centre, self.spread, self.mean, self.v = idf, centre, spread, mean, v

    @classmethod
    def fit(cls, x: np.ndarray, dims: int) -> Basis:
        """Leading singular directions of the scaled and centred features, by subspace iteration from a fixed start."""
        counts, rates = x[:, :-RATES], x[:, -RATES:].astype(np.float64)
        idf = np.log((1 + len(x)) / (1 + np.count_nonzero(counts, axis=0))).astype(np.float32) + 1
        basis = cls(idf, rates.mean(axis=0).astype(np.float32), np.maximum(rates.std(axis=0), 1e-6).astype(np.float32), np.zeros(x.shape[1], np.float32), np.zeros((x.shape[1], 0), np.float32))
        y = basis._scaled(x)
        basis.mean = y.mean(axis=0)
        y -= basis.mean
        q = np.random.default_rng(7).standard_normal((y.shape[1], min(dims + 16, *y.shape))).astype(np.float32)
        for _ in range(4):
            q, _ = np.linalg.qr(y.T @ (y @ q))
        _, _, v = np.linalg.svd(y @ q, full_matrices=False)
        basis.v = np.ascontiguousarray((q @ v.T)[:, :dims])
        return basis

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        y = x.astype(np.float32)
        counts, rates = y[:, :-RATES], y[:, -RATES:]
        counts *= self.idf
        counts /= np.maximum(np.sqrt(np.einsum("ij,ij->i", counts, counts))[:, None], 1e-9)
        rates[:] = np.clip((rates - self.centre) / self.spread, -4, 4) * np.float32(0.15)
        return y

    def vectors(self, x: np.ndarray) -> np.ndarray:
        z = (self._scaled(x) - self.mean) @ self.v
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)


def vote(vectors: np.ndarray, sample: np.ndarray, labels: np.ndarray, k: int) -> np.ndarray:
    """Share of the k nearest sample vectors' weights that carry label 1; those as near as the k-th vote too."""
    cosine = np.round(vectors @ sample.T, 6)
    k = min(k, len(labels))
    last = np.partition(cosine, len(labels) - k, axis=1)[:, len(labels) - k]
    row, near = np.nonzero(cosine >= last[:, None])
    weight = np.maximum((1 + cosine[row, near].astype(float)) / 2, 1e-6) ** SHARPNESS
    return np.bincount(row, weight * labels[near], len(vectors)) / np.bincount(row, weight, len(vectors))


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, mod 5; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def sample_of(docs: DataFrame, labels: DataFrame, most: int = MAX_SAMPLE) -> DataFrame:
    """(__id, quality, text): one row for each of at most so many labels."""
    known = labels.where(F.col("quality").isNotNull() & (fold() != 0)).select(F.col("doc_id").alias("__id"), "quality").distinct().orderBy(F.xxhash64("__id"), "__id", "quality").limit(most)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("__id"))
    return rows.groupBy("__id", "quality").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_SAMPLE, dims: int = DIMS) -> bytes | None:
    """The pickled (Basis, vectors, labels) of the sample; None without a sample."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _passes(batch):
                x = features(part["text"]).astype(np.float16)
                yield pa.RecordBatch.from_arrays([part["__id"].cast(pa.string()), part["quality"].cast(pa.int32()), pa.array([zstandard.compress(r.tobytes(), 1) for r in x], pa.binary())], names=["id", "quality", "x"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(q, i, x) for b in batches for q, i, x in zip(b["quality"].to_pylist(), b["id"].to_pylist(), b["x"].to_pylist(), strict=True)]
        rows.sort()
        x = np.empty((len(rows), WIDTH), np.float16)
        for i, r in enumerate(rows):
            x[i] = np.frombuffer(zstandard.decompress(r[2]), np.float16)
        if len(rows):
            basis = Basis.fit(x, dims)
            vectors = np.concatenate([basis.vectors(x[i : i + _PASS_DOCS]) for i in range(0, len(x), _PASS_DOCS)])
            made = pickle.dumps((basis, vectors, np.array([r[0] > 0 for r in rows], float)))
            yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], names=["model"])

    made = sample_of(docs, labels, most).mapInArrow(describe, "id string, quality int, x binary").repartition(1).mapInArrow(learn, "model binary").collect()
    return bytes(made[0].model) if made else None


def _passes(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of some documents or about 1 MB of text."""
    size = np.cumsum(pa.compute.coalesce(pa.compute.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        base = size[at - 1] if at else 0
        end = min(at + _PASS_DOCS, batch.num_rows, max(at + 1, int(np.searchsorted(size, base + (1 << 20)))))
        yield batch.slice(at, end - at)
        at = end


def scored(docs: DataFrame, labels: DataFrame, k: int = NEIGHBOURS, threshold: float = THRESHOLD) -> DataFrame:
    """docs with held_out, score and predicted; columns of docs with these names are replaced."""
    spark = docs.sparkSession
    tune(spark)
    docs = docs.drop("held_out", "score", "predicted")
    model = spark.sparkContext.broadcast(fit(docs, labels))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema.fields]).add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pickle.loads(model.value) if model.value is not None else None
        for batch in batches:
            score = np.full(batch.num_rows, 0.5)
            if known is not None:
                basis, sample, label = known
                score = np.concatenate([vote(basis.vectors(features(part["text"])), sample, label, k) for part in _passes(batch)] or [score])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, "score"])

    out = docs.mapInArrow(run, schema)
    return out.withColumn("held_out", F.coalesce(fold() == 0, F.lit(False))).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs.select("doc_id", "text"), labels).select("doc_id", "held_out", "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs without those that score below the threshold; all columns pass unchanged."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" if c not in ("doc_id", "text") else c for i, c in enumerate(names)])  # clashing names pass too
    good = scored(plain, labels, threshold=threshold).where("predicted = 1").select(*plain.columns)
    return good.toDF(*names)
