"""Connected components of an edge table by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.llm.scratch import Scratch

#: Keys that more than one in so many rows have are broadcast; there can't be more keys than that.
HOT = 10_000


def spread_join(rows: DataFrame, table: DataFrame, key: str, n: int) -> DataFrame:
    """rows (a stored table of n rows) left join table, which has a key once; no task gets all rows of a frequent key."""
    hot = rows.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > n // HOT + 1).select(key)
    keys = F.broadcast(hot)  # at most HOT rows
    return rows.join(F.broadcast(hot.join(table, key, "left")), key).unionByName(rows.join(keys, key, "left_anti").join(table, key, "left"))


def components(edges: DataFrame, work: Scratch) -> DataFrame:
    """(node, label) for every node of edges (a, b): the smallest node it is connected with.

    Each round takes the least label among a node's neighbours, then the label
    of that label, so the longest path halves or better; a node with many
    edges only takes part in partial aggregates and joins that can be split."""
    both = work.keep(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = work.keep(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("m"))
        least = both.join(of_b, "b").groupBy("a").agg(F.min("m").alias("m")).select(F.col("a").alias("node"), "m")
        near = labels.join(least, "node").select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        new = work.keep(near.join(jump, "label", "left").select("node", "old", F.least("label", F.coalesce("far", "label")).alias("label")), "labels")
        changed = new.where("label <> old").limit(1).count()
        work.drop(labels)
        labels = new.drop("old")
        labels._fundlake_path = new._fundlake_path
        if not changed:
            work.drop(both)
            return labels
