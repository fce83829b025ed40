"""A training corpus from ``documents``: five stages, each one operator over all its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next one's docs. A stage's intermediate
tables are removed when the next one begins.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from fundlake.llm import decontaminate as _decontaminate
from fundlake.llm import line_dedup, mixing, near_dedup, quality, scratch

SCOPE = "pipeline"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    scratch.release(spark, SCOPE)
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them."""
    scratch.release(spark, SCOPE)
    return line_dedup.dedup_lines(docs, scope=SCOPE)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    scratch.release(spark, SCOPE)
    return near_dedup.keep_one(docs, scope=SCOPE)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with passages of the benchmark go."""
    scratch.release(spark, SCOPE)
    return _decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"), scope=SCOPE)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document that it takes, with its copies and the words they make."""
    scratch.release(spark, SCOPE)
    return mixing.mix_sources(docs, scope=SCOPE).where("copies > 0")


STAGES = [("quality", good), ("line_dedup", lines), ("near_dedup", distinct), ("decontaminate", clean), ("mix", mixed)]
#: The stages are not all expressible in SQL; each is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. A stage's table is deleted once the next one has been written."""
    docs, before = _table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = f"{scratch.folder(spark)}/fundlake-stage-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            scratch.remove(spark, before)
        before = path
    scratch.release(spark, SCOPE)
    return docs
