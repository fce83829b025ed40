"""Exact top-k inner products by multi-resolution segment statistics.

Vectors are turned into integers, floor(64 * x). For each vector and resolution
the components are cut into segments; a segment is summed up by its mean and
its deviation (root of the summed squares about the mean). By the inequality of
Cauchy and Schwarz the inner product of two vectors is at most

    sum over segments of n * mean * mean' + deviation * deviation'

that is, their squared distance |x|^2 + |y|^2 - 2 x.y has a lower bound, and the
bound is itself an inner product of 2 numbers a segment. First every query is
scored exactly against a few candidates, of bounded size and the same for all
(``SEEDS``); its k-th score there is its floor everywhere. Some of these are
pivots; every vector goes to the cell of the pivot whose statistics are nearest.
The ranges of a cell's statistics bound the scores of all its vectors, so a
query meets only the cells whose bound reaches its floor: the coarsest of the
resolutions, and it is applied before anything is sent. A cell is cut into
blocks of bounded size by a hash, however many vectors it has.

Where a block of queries meets a block of candidates, exact scores of a few
more raise the floor, bounds from coarse to fine discard candidates that cannot
reach it, and the survivors are scored exactly. A meeting gives a query's
candidates that reach its floor, k at most. Queries are a stated set; a block
of candidates is sent only to the blocks of queries that ask for it.

Rules: the score is the integer inner product; a query's own row (same id) is
no candidate; ties go to the smaller id. Vectors that are null or hold null or
non-finite components take no part.

Edge cases: fewer candidates than k give all of them. Vectors of unlike length
are compared as if the shorter went on with zeros; in memory, vectors are filled
up at most to the next power of two, and a block is bounded by bytes, so one
very wide vector makes no other larger. Seeds are no wider than half of the
candidates; if even one is too large to be shared there are no seeds, so no
floors and one cell, and the result is the same. Scores are exact whatever the
components' size; one outside 64 bits counts as the largest (smallest) such
number. A finite component that is not finite after scaling counts as
non-finite. Rows that repeat an id are candidates each; a repeated query id gets
one list (of all rows' scores, best first). Null ids take no part. An empty
table gives an empty result. Other columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlake.llm.scratch import Scratch

SCALE = 64.0
#: Bytes of a block of candidates and of queries that meet in one task, and its rows at most.
BLOCK_BYTES, BLOCK = 32 << 20, 65536
#: Candidates that all queries are scored against first, and their bytes at most.
SEEDS, SEED_BYTES = 4096, 32 << 20
#: Cells at most, and the number of segments whose statistics place a vector.
CELLS_MOST, PLACING = 1024, 16
#: Segments of each resolution, coarse to fine.
RESOLUTIONS = (4, 16)
#: Bounds of a block's queries that are computed at once.
CELLS = 1 << 22
#: Candidates of a block scored before the others.
LOCAL_SEEDS = 256
_EXACT = float(1 << 53)
#: Share of the product of two lengths by which a bound may be off in floating point, and more.
SLACK = 1e-9


def usable(vector: str, scale: float = SCALE) -> Column:
    """Neither null nor holding a null or non-finite component."""
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < float("inf")))


def integers(vector: str, scale: float = SCALE) -> Column:
    """floor(scale * x) as doubles; beyond 2**52 all are whole numbers."""
    whole = lambda y: F.when(F.abs(y) < float(1 << 52), F.floor(y).cast("double")).otherwise(y)
    return F.transform(vector, lambda x: whole(x.cast("double") * scale))


class Vectors:
    """Vectors of unlike length: their components one after the other, and how many each has."""

    def __init__(self, column: pa.Array | pa.ChunkedArray):
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        self.n = np.diff(column.offsets.to_numpy())
        self.flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
        self.start = np.cumsum(self.n) - self.n

    def dense(self, rows: np.ndarray, width: int) -> np.ndarray:
        """Some rows as a matrix, cut or filled up with zeros."""
        n = np.minimum(self.n[rows], width)
        if len(rows) and (n == width).all() and len(rows) == len(self.n) and (self.n == width).all():
            return self.flat.reshape(len(rows), width)
        out = np.zeros((len(rows), width))
        row = np.repeat(np.arange(len(rows)), n)
        at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        out[row, at] = self.flat[np.repeat(self.start[rows], n) + at]
        return out

    def classes(self) -> Iterator[tuple[np.ndarray, int]]:
        """Rows by the power of two that their length reaches, with the greatest length."""
        size = np.ceil(np.log2(np.maximum(self.n, 1)))
        for x in np.unique(size):
            rows = np.flatnonzero(size == x)
            yield rows, max(int(self.n[rows].max()), 1)

    def stats(self, width: int, segments: int) -> np.ndarray:
        """``summary`` of the vectors as if filled up to a width."""
        parts = min(segments, width)
        sizes = np.full(parts, width // parts) + (np.arange(parts) < width % parts)
        at = np.arange(len(self.flat)) - np.repeat(self.start, self.n)
        cell = np.repeat(np.arange(len(self.n)), self.n) * parts + np.searchsorted(np.cumsum(sizes), at, side="right")
        cells, size = len(self.n) * parts, np.tile(sizes, len(self.n))
        with np.errstate(all="ignore"):
            mean = np.bincount(cell, weights=self.flat, minlength=cells) / size
            off = np.bincount(cell, weights=(self.flat - mean[cell]) ** 2, minlength=cells).astype(float)
            empty = size - np.bincount(cell, minlength=cells)
            off[empty > 0] += empty[empty > 0] * mean[empty > 0] ** 2
            out = np.empty((len(self.n), 2 * parts))
            out[:, 0::2], out[:, 1::2] = (mean * np.sqrt(size)).reshape(-1, parts), np.sqrt(off).reshape(-1, parts)
        return out


def summary(x: np.ndarray, segments: int) -> np.ndarray:
    """Per vector, for each segment sqrt(n) * mean and the deviation: products of these bound inner products."""
    parts = np.array_split(np.arange(x.shape[1]), min(segments, x.shape[1]))
    out = np.empty((len(x), 2 * len(parts)))
    for i, p in enumerate(parts):
        with np.errstate(all="ignore"):
            mean = x[:, p].mean(axis=1)
            out[:, 2 * i] = mean * math.sqrt(len(p))
            out[:, 2 * i + 1] = np.sqrt(np.maximum(((x[:, p] - mean[:, None]) ** 2).sum(axis=1), 0))
    return out


def _exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of q with all of c; beyond 64 bits the nearest such number."""
    with np.errstate(all="ignore"):
        large = ~(np.abs(q).max(axis=1, initial=0)[:, None] * np.abs(c).max(axis=1, initial=0)[None, :] * q.shape[1] < _EXACT)
        out = (q @ c.T).astype(np.int64)
    whole: dict[tuple[int, int], list[int]] = {}
    row = lambda of, x, i: whole.setdefault((of, i), [int(v) for v in x[i]])
    for i, j in zip(*np.nonzero(large), strict=True):
        out[i, j] = max(min(sum(map(mul, row(0, q, i), row(1, c, j))), (1 << 63) - 1), -(1 << 63))
    return out


def floors(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int) -> np.ndarray:
    """Each query's k-th score among some candidates, without its own row; -inf if they are fewer."""
    if len(c) < k or not len(q):
        return np.full(len(q), -np.inf)
    scores = _exact(q, c).astype(float)
    scores[qid[:, None] == cid[None, :]] = -np.inf
    return np.partition(scores, -k, axis=1)[:, -k]


def best(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of each query's k best among the candidates of a block, none below its least."""
    levels = [(summary(q, s), summary(c, s)) for s in RESOLUTIONS]
    with np.errstate(all="ignore"):
        lengths = [np.sqrt((x**2).sum(axis=1)) for x in (q, c)]
    ids, others, scores = [], [], []
    step = max(1, CELLS // max(len(c), 1))
    seeds = np.arange(0, len(c), max(1, len(c) // LOCAL_SEEDS))
    for at in range(0, len(q), step):
        rows = slice(at, at + step)
        floor = floors(qid[rows], q[rows], cid[seeds], c[seeds], k)
        if least is not None:
            floor = np.maximum(floor, least[rows])
        # Bounds of the coarse resolution for all; the finer one only where that leaves a candidate. What is no number rules nothing out.
        with np.errstate(all="ignore"):
            bound = levels[0][0][rows] @ levels[0][1].T
        for i in range(bound.shape[0]):
            with np.errstate(all="ignore"):
                reach = floor[i] - SLACK * (1 + lengths[0][at + i] * lengths[1])
                left = np.flatnonzero(~(bound[i] < reach))
                for a, b in levels[1:]:
                    if len(left) > 2 * k:
                        left = left[~(b[left] @ a[at + i] < reach[left])]
            left = left[cid[left] != qid[at + i]]
            s = _exact(q[at + i : at + i + 1], c[left])[0] if len(left) else np.zeros(0, np.int64)
            left, s = left[s >= floor[i]], s[s >= floor[i]]
            if len(left) > k:
                keep = s >= np.partition(s, -k)[-k]
                left, s = left[keep], s[keep]
                order = np.lexsort((cid[left], -s))[:k]
                left, s = left[order], s[order]
            ids.append(np.full(len(left), qid[at + i]))
            others.append(cid[left])
            scores.append(s)
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return join(ids), join(others), join(scores)


def _meet(k: int):
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64),) * 3]
        if queries.num_rows and candidates.num_rows:
            q, c = Vectors(queries["v"]), Vectors(candidates["v"])
            qid, cid, least = queries["id"].to_numpy(), candidates["id"].to_numpy(), queries["least"].to_numpy()
            for some, a in q.classes():
                for others, b in c.classes():
                    width = min(a, b)  # what goes beyond meets zeros
                    found.append(best(qid[some], q.dense(some, width), cid[others], c.dense(others, width), k, least[some]))
        return pa.table([pa.array(np.concatenate(x), pa.int64()) for x in zip(*found, strict=True)], names=["query_id", "vec_id", "score"])

    return run


def nearest(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The pivot (a row of statistics) nearest to each row."""
    with np.errstate(all="ignore"):
        return ((pivots**2).sum(axis=1)[None, :] - 2 * (x @ pivots.T)).argmin(axis=1)


def reached(q: np.ndarray, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Which cells (columns) may hold a score of at least least for each query (row), by the ranges of the cells' statistics."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    with np.errstate(all="ignore"):
        bound = up @ high.T + down @ low.T
        size = np.abs(q) @ np.maximum(np.abs(low), np.abs(high)).T
        return ~(bound < least[:, None] - SLACK * (1 + size))


def _placed(rows: DataFrame, pivots: np.ndarray, width: int) -> DataFrame:
    """(id, v, cell)."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = nearest(Vectors(batch["v"]).stats(width, PLACING), shared.value)
            yield pa.RecordBatch.from_arrays([batch["id"], batch["v"], pa.array(cell, pa.int64())], names=["id", "v", "cell"])

    return rows.mapInArrow(run, "id long, v array<double>, cell long")


def _ranges(placed: DataFrame, cells: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest of each statistic in each cell: at most CELLS_MOST rows of 2 * PLACING numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, cell = Vectors(batch["v"]).stats(width, PLACING), batch["cell"].to_numpy()
            order = np.argsort(cell, kind="stable")
            held, first = np.unique(cell[order], return_index=True)
            if len(held):
                low, high = np.minimum.reduceat(x[order], first), np.maximum.reduceat(x[order], first)
                n = x.shape[1]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(held, n)), pa.array(np.tile(np.arange(n), len(held))), pa.array(low.ravel()), pa.array(high.ravel())], names=["cell", "k", "low", "high"])

    rows = placed.mapInArrow(run, "cell long, k long, low double, high double").groupBy("cell", "k").agg(F.min("low").alias("low"), F.max("high").alias("high")).toArrow()
    n = 2 * min(PLACING, width)
    low, high = np.zeros((cells, n)), np.zeros((cells, n))  # of a cell without vectors no one asks
    at = rows["cell"].to_numpy(), rows["k"].to_numpy()
    low[at], high[at] = rows["low"].to_numpy(), rows["high"].to_numpy()
    return low, high


def _loads(rows: DataFrame, cells: int, most: int) -> np.ndarray:
    """How many blocks, of so many rows and of BLOCK_BYTES at most, each cell's rows fill."""
    out = np.zeros(cells)
    for x in rows.groupBy("cell").agg(F.count("*").alias("n"), F.sum(F.size("v")).alias("sum")).collect():  # at most CELLS_MOST rows
        out[x.cell] = max(x.n / most, 8 * x.sum / BLOCK_BYTES)
    return out


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 20, scale: float = SCALE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score; both inputs have vec_id and embedding."""
    work = Scratch(vectors.sparkSession)
    spark = vectors.sparkSession
    whole = lambda d: d.where(usable("embedding", scale) & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("id"), integers("embedding", scale).alias("v"))
    q, c = work.keep(whole(queries), "topk-queries"), work.keep(whole(vectors), "topk-vectors")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = [d.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"), F.sum(F.size("v")).alias("sum"), F.percentile_approx(F.size("v"), 0.5).alias("half")).first() for d in (q, c)]
    if not known[1].n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width, half = max(1, *(x.width or 0 for x in known)), max(known[1].half, 1)
    # Blocks of candidates are smaller where they would be too few for the cluster.
    rows = max(1, min(BLOCK, BLOCK_BYTES * known[1].n // (8 * max(known[1].sum, 1)), -(-known[1].n // parts)))
    few = c.where(F.size("v") <= half).orderBy(F.xxhash64("id"), "id", "v").limit(min(SEEDS, SEED_BYTES // (8 * half))).toArrow()
    ids, near = few["id"].to_numpy(), Vectors(few["v"])
    seeds, pivots = near.dense(np.arange(len(ids)), half) if len(ids) else np.zeros((0, 1)), near.stats(width, PLACING)[: max(1, min(CELLS_MOST, known[1].n // rows))]
    if not len(pivots):
        pivots = np.zeros((1, 2 * min(PLACING, width)))
    placed = work.keep(_placed(c, pivots, width), "topk-cells")
    low, high = _ranges(placed, len(pivots), width)
    blocks = np.ceil(_loads(placed, len(pivots), rows)).astype(np.int64)
    shared = spark.sparkContext.broadcast((ids, seeds, pivots, low, high, blocks))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, seeds, pivots, low, high, blocks = shared.value
        every = [(np.int64(p) << 32) + np.arange(n) for p, n in enumerate(blocks.tolist())]
        for batch in batches:
            x, qid = Vectors(batch["v"]), batch["id"].to_numpy()
            stats, least = x.stats(width, PLACING), np.full(len(qid), -np.inf)
            for some, most in x.classes() if len(ids) >= k else ():
                w = min(most, seeds.shape[1])
                least[some] = floors(qid[some], x.dense(some, w), ids, seeds[:, :w], k)
            wanted = [np.concatenate([every[p] for p in np.flatnonzero(hit)] or [np.zeros(0, np.int64)]) for hit in reached(stats, low, high, least)]
            yield pa.RecordBatch.from_arrays([batch["id"], batch["v"], pa.array(least), pa.array(nearest(stats, pivots), pa.int64()), pa.array(wanted, pa.list_(pa.int64()))], names=["id", "v", "least", "cell", "blocks"])

    asked = work.keep(q.mapInArrow(ask, "id long, v array<double>, least double, cell long, blocks array<long>"), "topk-asked")
    # Queries of a cell stay together, as they ask for much the same: cells are gathered to batches, and one with many is cut by a hash.
    load = _loads(asked, len(pivots), BLOCK)
    batches = spark.createDataFrame([(i, int(b), int(np.ceil(n))) for i, (b, n) in enumerate(zip(np.ceil(np.cumsum(load)), load, strict=True)) if n] or [(0, 0, 1)], "cell long, batch long, cuts long")
    batch = (F.shiftleft(F.col("batch"), 32) + F.pmod(F.xxhash64("id", F.lit(1)), F.col("cuts"))).alias("a")
    left = asked.join(F.broadcast(batches), "cell").select("id", "v", "least", batch, F.explode("blocks").alias("b"))
    meetings = work.keep(left.select("a", "b").distinct(), "topk-meetings")
    sizes = spark.createDataFrame([(i, int(n)) for i, n in enumerate(blocks)], "cell long, cuts long")
    block = (F.shiftleft(F.col("cell"), 32) + F.pmod(F.xxhash64("id", F.lit(2)), F.col("cuts"))).alias("b")
    right = placed.join(F.broadcast(sizes), "cell").select("id", "v", block).join(meetings, "b").select("id", "v", "a", "b")
    met = left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInArrow(_meet(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
