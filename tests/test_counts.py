"""Changes told by the join that makes them, counts taken while a table is written, values of unknown shape."""

import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from fundlake.functions import variants
from fundlake.operators import merge
from fundlake.plans import pipeline

T = "k long, a string, v double"


@pytest.fixture
def frames(spark):
    target = spark.createDataFrame([(1, "x", 1.0), (2, "x", None), (3, None, 3.0), (4, "x", 4.0), (5, None, None)], T)
    source = spark.createDataFrame([(1, "x", 1.0), (2, "x", 2.0), (3, "y", 9.0), (5, None, 5.0), (9, "n", None)], T)
    return target, source


def changes(df):
    return {r.k: (r.a, r.v, r._change) for r in df.collect()}


def test_tracked(frames):
    target, source = frames
    assert changes(merge.tracked(target, source, ["k"], ["a", "v"], "upsert")) == {1: ("x", 1.0, "kept"), 2: ("x", 2.0, "filled"), 3: ("y", 9.0, "updated"), 4: ("x", 4.0, "kept"), 5: (None, 5.0, "filled"), 9: ("n", None, "inserted")}
    assert changes(merge.tracked(target, source, ["k"], ["v"], "fill")) == {1: ("x", 1.0, "kept"), 2: ("x", 2.0, "filled"), 3: (None, 3.0, "kept"), 4: ("x", 4.0, "kept"), 5: (None, 5.0, "filled")}
    for mode in ("overwrite", "found", "fill"):
        plain = merge.update(target, source, ["k"], ["a", "v"], mode)
        assert sorted(merge.tracked(target, source, ["k"], ["a", "v"], mode).drop("_change").collect()) == sorted(plain.collect())


def test_counts_come_with_the_write(spark, frames, tmp_path, caplog):
    target, source = frames
    counts = {}
    stages = [("load", lambda s, t: {"funds": target}), ("fill", lambda s, t: {"funds": merge.tracked(t["funds"], source, ["k"], ["v"], "fill")}), ("none", None)]
    with caplog.at_level("INFO", "fundlake"):
        out = pipeline.run(spark, {}, stages, f"file://{tmp_path}", counts)
    assert counts == {"load.funds": {"rows": 5}, "fill.funds": {"rows": 5, "inserted": 0, "updated": 0, "filled": 2, "kept": 3}}
    assert "fill: funds: 5 rows, 0 inserted, 0 updated, 2 filled, 3 kept" in caplog.text
    assert out["funds"].columns == ["k", "a", "v"] and out["funds"].where("v IS NULL").count() == 0
    again, found = pipeline.store(target, f"file://{tmp_path}/x", named=F.count("a"))
    assert found == {"rows": 5, "named": 3} and again.count() == 5


def test_variants(spark):
    texts = ['{"a": {"b": [1, "2", null, {"c": 1.5}]}, "d": "2024-01-02"}', '```json\n{"a": 7}\n```', "``` [1, 2]```", '{"a": ', "", None, "null", "3", '{"a": {"b": {"x": 1, "y": [true]}}}', "geen json"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, t string").select("i", variants.reply(F.col("t")).alias("v"))
    got = {r.i: tuple(r)[1:] for r in df.select("i", F.col("v").isNotNull(), variants.field(F.col("v"), "$.a.b[0]", "long"), variants.field(F.col("v"), "$.a.b[1]"), variants.field(F.col("v"), "$.a.b[3].c", "decimal(5,2)"), variants.field(F.col("v"), "$.d", "date"), variants.field(F.col("v"), "$.a", "int"), variants.field(F.col("v"), "$[1]", "int")).collect()}
    assert got[0] == (True, 1, "2", decimal.Decimal("1.50"), datetime.date(2024, 1, 2), None, None)
    assert got[1] == (True, None, None, None, None, 7, None) and got[2] == (True, None, None, None, None, None, 2)
    assert [got[i][0] for i in (3, 4, 5, 9)] == [False] * 4 and got[7][0]
    rows = variants.entries(df, "v", "$.a.b")
    assert [tuple(r) for r in rows.where("pos IS NOT NULL").select("i", "pos", "key", variants.field(F.col("value"), "$").alias("x")).orderBy("i", "pos").collect()] == [(0, 0, None, "1"), (0, 1, None, "2"), (0, 2, None, None), (0, 3, None, '{"c":1.5}'), (8, 0, "x", "1"), (8, 1, "y", "[true]")]
