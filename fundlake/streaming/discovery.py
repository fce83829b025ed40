"""Incremental discovery (STM-01): addresses not seen before are appended, batch by batch.

As a batch job (``append_new``) it is an anti-join with the table so far, and
``watch`` does that for each batch of a stream, so others may write to the table
too. Where the table is the stream's own (``watch_keyed``) the keys seen are kept
in Spark's state store, dealt by key and kept on disk by RocksDB, so a micro-batch reads only its own keys' state and
never the table. The sink lists the files of each finished batch, and a batch
that is run again after a failure takes the place of itself: nothing comes twice.
A key's state can end some time after its row (``forget``); then an address that
turns up again is news again, and the state does not grow with the stream's age.

Edge cases: a null key is a key like others; of a key's rows in one batch one
is kept. Rows that the table had before the stream began are known to it: they
are met once, when the stream first starts (``known``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fundlake.operators.merge import insert_new

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def append_new(spark: SparkSession, found: DataFrame, path: str, key: str = "url") -> None:
    """Append rows of unseen keys to the table at path."""
    known = spark.read.parquet(path) if _is_there(spark, path) else spark.createDataFrame([], found.schema)
    insert_new(known, found, [key]).select(*found.columns).write.mode("append").parquet(path)


def _is_there(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def first_seen(source: DataFrame, key: str = "url", time: str | None = None, forget: str | None = None) -> DataFrame:
    """Of a stream the first row of each key; with a column of times, a key's state ends so long (forget) after the row that made it, by the stream's own time."""
    if forget is None:
        return source.dropDuplicates([key])
    return source.withWatermark(time, forget).dropDuplicatesWithinWatermark([key])


def watch(source: DataFrame, path: str, checkpoint: str, key: str = "url", once: bool = True) -> StreamingQuery:
    """Keep the table at path up to date from a stream of found rows, whoever else writes to it."""
    writer = source.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda batch, _: append_new(batch.sparkSession, batch, path, key))
    return (writer.trigger(availableNow=True) if once else writer).start()


def watch_keyed(source: DataFrame, path: str, checkpoint: str, key: str = "url", once: bool = True, known: str | None = None, time: str | None = None, forget: str | None = None) -> StreamingQuery:
    """Append new keys of a stream of found rows to the table at path, which only this stream writes; known: another table whose keys are no news.

    Started again with the same checkpoint, it goes on where it stopped."""
    spark = source.sparkSession
    new = source
    if known is not None:
        old = spark.read.parquet(known).select(F.col(key).alias("_old")).distinct().withColumn("_known", F.lit(True))
        new = source.join(old, F.col(key).eqNullSafe(F.col("_old")), "left").where("_known IS NULL").select(*source.columns)
    writer = first_seen(new, key, time, forget).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, ROCKS)
    try:  # the stream has the settings of its start; the session keeps its own
        return (writer.trigger(availableNow=True) if once else writer).start()
    finally:
        spark.conf.set(provider, before)
