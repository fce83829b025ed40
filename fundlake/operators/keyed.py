"""A table kept by key, so that changes shuffle only what is new (SNK-06 to SNK-15).

The table lies in parts by a hash of its key, each part one sorted bucket. A
change is joined part by part: Spark knows how the table is dealt, so only the
source is shuffled, and only to the parts that it touches. Those parts are written
anew, the others are not read at all. A part changes when all of the change has
been written (dynamic overwrite of partitions), so a job that fails changes none.

Edge cases: a null key is a key that nothing matches; rows with null keys lie in
a part of their own hash. A key that the source has twice is refused by whoever
joins (``merge.last_by`` makes one of them). An empty source changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.operators import merge

_PART = "_part"
_DYNAMIC = "spark.sql.sources.partitionOverwriteMode"


class KeyedTable:
    """A folder of Parquet files dealt by key, known to the session under a name of its own."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], parts: int = 64):
        self.spark, self.path, self.schema, self.keys, self.parts = spark, path.rstrip("/"), schema, list(keys), parts
        self.columns = spark.createDataFrame([], schema).columns
        self.name = f"keyed_{uuid.uuid4().hex}"
        by = ", ".join(f"`{k}`" for k in self.keys)
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(place)
        spark.sql(f"CREATE TABLE {self.name} ({schema}, {_PART} int) USING parquet PARTITIONED BY ({_PART}) CLUSTERED BY ({by}) SORTED BY ({by}) INTO {parts} BUCKETS LOCATION '{self.path}'")
        spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")

    def close(self) -> None:
        """Forget the name; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def frame(self) -> DataFrame:
        """All rows; it is read by its folder and stays good when the name is forgotten."""
        return self.spark.read.schema(f"{self.schema}, {_PART} int").parquet(self.path).select(*self.columns)

    def _part(self, df: DataFrame) -> DataFrame:
        return df.withColumn(_PART, F.pmod(F.hash(*self.keys), F.lit(self.parts)).cast("int"))

    def _write(self, rows: DataFrame) -> None:
        before = self.spark.conf.get(_DYNAMIC)
        self.spark.conf.set(_DYNAMIC, "dynamic")
        try:
            self._part(rows.select(*self.columns)).write.mode("overwrite").insertInto(self.name)
        finally:
            self.spark.conf.set(_DYNAMIC, before)

    def replace(self, rows: DataFrame) -> None:
        """Fill the table, whose parts that no row falls into are left as they are."""
        self._write(rows.repartition(self.parts, *self.keys))

    def touched(self, source: DataFrame) -> DataFrame:
        """The rows of the parts that a source's keys fall into."""
        held = [r[0] for r in self._part(source.select(*self.keys)).select(_PART).distinct().collect()]  # as many as there are parts at most
        return self.spark.table(self.name).where(F.col(_PART).isin(held)).drop(_PART)

    def change(self, source: DataFrame, how: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
        """What the touched parts become: how(their rows, source)."""
        return how(self.touched(source), source)

    def apply(self, source: DataFrame, how: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        self._write(self.change(source, how))

    def upsert(self, source: DataFrame, columns: Sequence[str]) -> None:
        """SNK-07, SNK-08."""
        self.apply(source, lambda t, s: merge.upsert(t, s, self.keys, columns))

    def upsert_replace(self, source: DataFrame) -> None:
        """SNK-06."""
        self.apply(source, lambda t, s: merge.upsert_replace(t, s, self.keys))

    def update(self, source: DataFrame, columns: Sequence[str], mode: str = "overwrite") -> None:
        """SNK-09 to SNK-15."""
        self.apply(source, lambda t, s: merge.update(t, s, self.keys, columns, mode))
