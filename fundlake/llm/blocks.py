"""Documents packed into compressed blocks of bounded size.

A block is one row: its number, and an Arrow stream of some rows of a table,
compressed with zstd. Operators that need facts about each document from the
whole corpus (how often does this line, word or passage occur elsewhere?) ask
per block and distinct key instead of per occurrence:

    requests (key, block, ...) -> one shuffle by key -> replies per block

A key that a third of all documents share gives one request for each block
that holds it, so no task gets all its occurrences. Blocks are stored as a
table bucketed by block number; replies are dealt to the buckets, so the text
itself is never shuffled. There are as many buckets, and as many partitions of
requests, as the input's size asks for: more data makes more tasks, not larger
ones.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlake.llm.scratch import Scratch

#: Bytes of text after which a block is closed; one longer text makes a longer block.
BLOCK_BYTES = 8 << 20
#: Spark's own limit of buckets is 100,000.
MOST_BUCKETS = 1 << 16
SCHEMA = "block long, payload binary"


def trim() -> None:
    """Give freed memory back to the system: a worker outlives its task, and what it keeps counts against the executor."""
    pa.default_memory_pool().release_unused()
    give = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if give is not None:
        give(0)


def encode(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def decode(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def pack(df: DataFrame, limit: int = BLOCK_BYTES) -> DataFrame:
    """Pack df into blocks. The numbers hold for one run: keep the result as a table before it is read twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([(part << 32) + made], pa.int64()), pa.array([encode(pa.Table.from_batches(held))], pa.binary())], names=["block", "payload"])

        for batch in batches:
            step = max(1, int(batch.num_rows * limit / 4 / max(batch.nbytes, 1)))
            for at in range(0, batch.num_rows, step):
                held.append(piece := batch.slice(at, step))
                size += piece.get_total_buffer_size() if step >= batch.num_rows else piece.nbytes
                if size >= limit:
                    yield close()
                    made, held, size = made + 1, [], 0
        if held:
            yield close()
        trim()

    return df.mapInArrow(run, SCHEMA)


def each(blocks: DataFrame, f: Callable[..., Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """f(block number, table, **other columns of the row) for each block; f yields record batches of schema."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [x for x in batch.schema.names if x not in ("block", "payload")]
            for i in range(batch.num_rows):
                yield from f(batch.column("block")[i].as_py(), decode(batch.column("payload")[i].as_buffer()), **{x: batch.column(x)[i] for x in names})
                trim()

    return blocks.mapInArrow(run, schema)


def bucket_count(df: DataFrame, limit: int = BLOCK_BYTES // 2) -> int:
    """Buckets for the blocks of df by the size of the tables it reads, some for each block so that few meet in one; at least one for each core.

    Where no table's size is known, it is the session's number of shuffle partitions."""
    spark = df.sparkSession
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    known = [x for x in sizes if x < 1 << 60]  # the rest stand for "unknown"
    if not known:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(max(spark.sparkContext.defaultParallelism, sum(known) // limit + 1), MOST_BUCKETS)


def store(df: DataFrame, work: Scratch, name: str, limit: int = BLOCK_BYTES) -> DataFrame:
    """The blocks of df as a kept table, bucketed by block."""
    return work.keep(pack(df, limit), name, ("block", bucket_count(df)))


def totals(requests: DataFrame, packed: DataFrame, keys: list[str], **sums: str) -> DataFrame:
    """Give each request the sums of its key over all blocks: name=expression summed. One shuffle by key."""
    w = Window.partitionBy(*keys)
    return requests.repartition(packed._fundlake_buckets, *keys).withColumns({name: F.expr(e).over(w) for name, e in sums.items()})


def reply(packed: DataFrame, answers: DataFrame, **columns: str) -> DataFrame:
    """Join stored blocks with the answers to them, each column gathered as an array: name=column of answers."""
    gathered = answers.repartition(packed._fundlake_buckets, "block").groupBy("block").agg(*[F.collect_list(c).alias(n) for n, c in columns.items()])
    return packed.join(gathered.hint("merge"), "block", "left")
