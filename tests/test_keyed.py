"""A table by key: changes as those of whole tables, only the source shuffled, only touched parts written."""

import os

import pytest
from pyspark.sql import functions as F

from fundlake.operators import merge
from fundlake.operators.keyed import KeyedTable

SCHEMA = "k long, name string, v double"


@pytest.fixture
def table(spark, tmp_path):
    t = KeyedTable(spark, f"file://{tmp_path}/t", SCHEMA, ["k"], 8)
    t.replace(rows(spark, 300))
    yield t
    t.close()


def rows(spark, n, first=0):
    return spark.range(first, first + n).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"), F.when(F.col("id") % 3 != 0, F.col("id") / 2).alias("v")).union(spark.createDataFrame([(None, "null", 1.0)] if first == 0 else [], SCHEMA))


def held(df):
    return sorted(map(str, df.collect()))


def source(spark, keys):
    return spark.createDataFrame([(k, f"s{k}", None if k % 2 else float(-k)) for k in keys], SCHEMA)


def test_changes(spark, table):
    plain, s = rows(spark, 300), source(spark, [1, 2, 3, 6, 500, 501])
    table.upsert(s, ["v"])
    plain = merge.upsert(plain, s, ["k"], ["v"])
    assert held(table.frame()) == held(plain)
    for mode in ("overwrite", "found", "fill"):
        s = source(spark, range(0, 60, 7))
        table.update(s, ["name", "v"], mode)
        plain = merge.update(plain, s, ["k"], ["name", "v"], mode)
        assert held(table.frame()) == held(plain)
    s = source(spark, [4, 5, 900])
    table.upsert_replace(s)
    assert held(table.frame()) == held(merge.upsert_replace(plain, s, ["k"]))
    before = held(table.frame())
    table.upsert(source(spark, [1]).limit(0), ["v"])
    assert held(table.frame()) == before


def test_only_the_source_is_shuffled(spark, table):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in (lambda t, s: merge.upsert(t, s, ["k"], ["v"]), lambda t, s: merge.update(t, s, ["k"], ["v"], "fill")):
            plan = table.change(source(spark, range(100)), how)._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange ") == 1 and plan.count("SortMergeJoin") == 1
            below = plan[plan.index("Exchange "):]
            assert "FileScan" not in below and "Bucketed: true" in plan  # the table is on the other side
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_touched_parts_are_written(spark, table, tmp_path):
    def files():
        return {os.path.join(d, f) for d, _, names in os.walk(tmp_path / "t") for f in names if f.endswith(".parquet")}

    before = files()
    table.upsert(source(spark, [7]), ["v"])
    parts = lambda some: {f.split("_part=")[1].split("/")[0] for f in some}
    assert len(before) == 8 and len(files()) == 8 and len(before - files()) == 1
    assert parts(before - files()) == parts(files() - before)
    assert table.touched(source(spark, [7])).count() < 80


def test_opened_again(spark, table, tmp_path):
    again = KeyedTable(spark, f"file://{tmp_path}/t", SCHEMA, ["k"], 8)
    assert held(again.frame()) == held(table.frame()) and again.frame().count() == 301
    again.close()


def test_a_change_that_fails_changes_nothing(spark, table):
    before = held(table.frame())
    with pytest.raises(Exception, match="no"):
        table.apply(source(spark, range(50)), lambda t, s: merge.upsert(t, s, ["k"], ["v"]).withColumn("v", F.when(F.col("k") == 30, F.raise_error(F.lit("no"))).otherwise(F.col("v"))))
    assert held(table.frame()) == before
