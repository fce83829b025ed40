"""Running values over blocks against windows, with a group of 90% of all rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fundlake.operators import scan

ROWS = "g string, k long, v long, flag boolean"


def made(n=4000):
    r = random.Random(1)
    rows = [(r.choice([None, "a", "b"]) if r.random() < 0.1 else "hot", k, r.choice([None, r.randint(-5, 9)]), r.random() < 0.001) for k in range(n)]
    return [*rows, ("all null", n, None, None), ("all null", n + 1, None, None), ("one", None, 3, True)]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(made(), ROWS).repartition(7).cache()


@pytest.mark.parametrize("order", ["asc", "desc", "asc_nulls_last"])
def test_as_windows(rows, order):
    order = getattr(F, order)("k")
    w = Window.partitionBy("g").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kinds = {"s": ("sum", F.col("v")), "c": ("count", F.col("v")), "m": ("max", F.col("v")), "n": ("min", F.col("v")), "l": ("last", F.col("v"))}
    plain = rows.withColumns({"s": F.sum("v").over(w), "c": F.count("v").over(w), "m": F.max("v").over(w), "n": F.min("v").over(w), "l": F.last("v", ignorenulls=True).over(w)})
    got = scan.scan(rows, ["g"], [order], 16, **kinds)
    assert got.columns == plain.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


def test_a_large_group_is_in_many_blocks(rows):
    at = scan.dealt(rows, ["g"], [F.asc("k")], 16)
    sizes = [r["count"] for r in at.where("g = 'hot'").groupBy("_block").count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 0.2 * sum(sizes)
    # Blocks follow each other in the group's order.
    ends = sorted((r.a, r.b) for r in at.where("g = 'hot'").groupBy("_block").agg(F.min("k").alias("a"), F.max("k").alias("b")).collect())
    assert all(x[1] < y[0] for x, y in zip(ends, ends[1:], strict=False))


def test_budget_stop_and_carry(rows):
    w = Window.partitionBy("g").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    size = F.abs(F.coalesce("v", F.lit(1)))
    plain = rows.withColumn("b", F.coalesce(F.sum(size).over(w), F.lit(0))).where("b <= 5000").drop("b")
    assert sorted(map(str, scan.budgeted(rows, ["g"], [F.asc("k")], size, 5000, 16).collect())) == sorted(map(str, plain.collect()))
    stopped = rows.withColumn("s", F.max(F.coalesce("flag", F.lit(False)).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).where("s = 0").drop("s")
    assert sorted(map(str, scan.until(rows, ["g"], [F.asc("k")], F.col("flag"), 16).collect())) == sorted(map(str, stopped.collect()))
    held = rows.withColumn("v", F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert sorted(map(str, scan.carried(rows, ["g"], [F.asc("k")], "v", 16).collect())) == sorted(map(str, held.collect()))


def test_edges(spark, rows):
    assert scan.scan(rows.limit(0), ["g"], [F.asc("k")], 4, s=("sum", F.col("v"))).collect() == []
    two = spark.createDataFrame([(None, None, 1, 5), (None, None, 2, 6), (None, "x", 1, 7)], "a string, b string, k long, v long")
    assert sorted(r.s for r in scan.scan(two, ["a", "b"], [F.asc("k")], 4, s=("sum", F.col("v"))).collect()) == [5, 7, 11]
    with pytest.raises(ValueError, match="running value"):
        scan.scan(rows, ["g"], [F.asc("k")], 4, s=("avg", F.col("v")))


def test_positions(spark, rows):
    got = {r.k: r.n for r in scan.positions(rows.where("k IS NOT NULL"), [F.desc("k")], "n", 9).collect()}
    assert got == {k: i for i, k in enumerate(sorted(got, reverse=True), 1)} and len(got) == 4002
    assert scan.positions(rows.limit(0), [F.asc("k")]).collect() == []
