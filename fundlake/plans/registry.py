"""Named queries over the driver's tables, each with the same query in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of a directory, read when named."""

    def __init__(self, spark: SparkSession, path: str, name: str = ""):
        self.spark, self.path, self.name = spark, path, name

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")


def query(sql: str | None = None, before: Callable[[SparkSession, str], None] | None = None) -> Callable[[Callable[[Tables], DataFrame]], Query]:
    """Register a function of tables under its name, with its SQL; before: called with the name ahead of each run."""

    def register(f: Callable[[Tables], DataFrame]) -> Query:
        def run(spark: SparkSession, path: str) -> DataFrame:
            if before is not None:
                before(spark, f.__name__)
            return f(Tables(spark, path, f.__name__))

        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = sql
        return run

    return register
