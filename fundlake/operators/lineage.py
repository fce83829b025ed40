"""Cutting the lineage of iterative plans; the folder for tables that steps leave for each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DEFAULT_DIR = "file:///tmp/checkpoints/fundlake"


def folder(spark: SparkSession) -> str:
    """The cluster's shared folder; one of our own only on a single machine, where every process sees it."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return (found or DEFAULT_DIR).rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """df checkpointed in the session's folder."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(folder(df.sparkSession))
    return df.checkpoint()
