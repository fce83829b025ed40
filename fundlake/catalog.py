"""The curated tables of a folder: created, read, looked up, replaced (SRC-01 to SRC-04, SNK-01, SNK-04, SNK-16)."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake import schemas


class Catalog:
    """Tables as Parquet folders under one root, with a view of each name."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def create(self) -> None:
        """SNK-01: every declared table that isn't there yet, empty."""
        for name, ddl in schemas.TABLES.items():
            self.spark.createDataFrame([], ddl).write.mode("ignore").parquet(self.path(name))
        self.views()

    def table(self, name: str) -> DataFrame:
        """A table with its declared columns; those that older files lack are null (schema evolution)."""
        reader = self.spark.read
        return (reader.schema(schemas.TABLES[name]) if name in schemas.TABLES else reader.option("mergeSchema", True)).parquet(self.path(name))

    def views(self) -> None:
        for name in schemas.TABLES:
            self.table(name).createOrReplaceTempView(name)

    def drop_views(self) -> None:
        """Take the views out of the session; frames made from them stay good."""
        for name in schemas.TABLES:
            self.spark.catalog.dropTempView(name)

    def sql(self, text: str, args: Mapping[str, object] | None = None) -> DataFrame:
        """SRC-01, SRC-02, FLT-11: a query over the views, with named parameters and never with pasted values."""
        return self.spark.sql(text, args=dict(args or {}))

    def names(self) -> list[str]:
        """SRC-03: the views of this session."""
        return sorted(t.name for t in self.spark.catalog.listTables())

    def append(self, name: str, rows: DataFrame) -> None:
        """SNK-04: rows take the declared types."""
        rows.select(*[F.col(f.name).cast(f.dataType) for f in self.table(name).schema.fields]).write.mode("append").parquet(self.path(name))

    def replace(self, name: str, rows: DataFrame) -> None:
        """SNK-16, SNK-30: the whole table at once. It is written beside the old one, so rows may come from the old one.

        The old table is moved aside before the new one takes its place and deleted after: at any
        moment one of them is whole, under its name or with .old behind it."""
        new, old, aside = f"{self.path(name)}.new", self.path(name), f"{self.path(name)}.old"
        rows.write.mode("overwrite").parquet(new)
        jvm = self.spark.sparkContext._jvm
        target, source, kept = (jvm.org.apache.hadoop.fs.Path(x) for x in (old, new, aside))
        fs = target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(target):
            fs.delete(kept, True)
            if not fs.rename(target, kept):
                raise OSError(f"{old} can't be moved to {aside}")
        if not fs.rename(source, target):
            fs.rename(kept, target)
            raise OSError(f"{new} can't be moved to {old}")
        fs.delete(kept, True)
        self.spark.catalog.refreshByPath(old)
        self.table(name).createOrReplaceTempView(name)


class Timed:
    """STM-02: results kept for some time after they were first asked for (an hour by default), then made anew."""

    def __init__(self, seconds: float = 3600, clock: Callable[[], float] = time.monotonic):
        self.seconds, self.clock = seconds, clock
        self._held: dict[str, tuple[float, DataFrame]] = {}

    def get(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        now, held = self.clock(), self._held.get(name)
        if held is not None and now - held[0] < self.seconds:
            return held[1]
        if held is not None:
            held[1].unpersist()
        self._held[name] = now, make().cache()
        return self._held[name][1]

    def clear(self) -> None:
        """Let go of everything that is held."""
        for _, df in self._held.values():
            df.unpersist()
        self._held = {}
