"""Intermediate tables in the cluster's shared folder.

Long lineages are cut by writing a table below ``spark.checkpoint.dir`` and
reading it back, so a lost executor costs one stage and never the whole job.
The folder is read from the session; only where it is unset and all processes
are on one machine a local default is used.

A table belongs to a scope. What an operator returns may still have to read its
tables, so they stay until ``release`` is called for their scope: a registered
query releases what its last call left, the pipeline what its last stage left.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from fundlake.operators.lineage import folder

#: Rows and bytes of one Arrow batch between the JVM and Python; texts and blocks can be long.
ARROW_ROWS, ARROW_BYTES = "1000", "4m"
#: Tables written so far in this process, by scope.
_WRITTEN: dict[str, list[str]] = {}
#: The scope of calls that name none.
_scope = "op"


def tune(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for long texts, in this session from now on: what is returned runs later."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


class Scratch:
    """Tables of one operator call; ``drop`` removes those no longer needed."""

    def __init__(self, spark: SparkSession, scope: str | None = None):
        self.spark, self.scope = spark, scope or _scope
        tune(spark)

    def keep(self, df: DataFrame, name: str, buckets: tuple[str, int] | None = None) -> DataFrame:
        """Write df and read it back; buckets: the column and number of buckets it is dealt to.

        A bucketed table is in the session's catalog only until it has been read back; the files stay."""
        path = f"{folder(self.spark)}/fundlake-{name}-{uuid.uuid4().hex}"
        _WRITTEN.setdefault(self.scope, []).append(path)
        write = df.write.option("compression", "zstd").option("path", path)
        if buckets is None:
            write.format("parquet").save()
            out = self.spark.read.schema(df.schema).parquet(path)
        else:
            table = f"fundlake_{uuid.uuid4().hex}"
            write.format("parquet").bucketBy(buckets[1], buckets[0]).saveAsTable(table)
            out = self.spark.table(table)
            self.spark.sql(f"DROP TABLE {table}")
            out._fundlake_buckets = buckets[1]
        out._fundlake_path = path
        return out

    def sweep(self) -> None:
        """Let go of the shuffle files of jobs that are done: Spark deletes them once the driver's collector finds them unused."""
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            remove(self.spark, t._fundlake_path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table of this module through Hadoop's file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    for written in _WRITTEN.values():
        if path in written:
            written.remove(path)


def release(spark: SparkSession, scope: str) -> None:
    """Delete every table that was written under scope."""
    for path in list(_WRITTEN.get(scope, ())):
        remove(spark, path)


@contextmanager
def scoped(spark: SparkSession, scope: str) -> Iterator[None]:
    """Tables written meanwhile belong to this scope; those it had before are deleted."""
    global _scope
    release(spark, scope)
    before, _scope = _scope, scope
    try:
        yield
    finally:
        _scope = before
