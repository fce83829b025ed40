"""Discovery as a stream: restarts, batches run again, known tables, keys that are forgotten."""

import datetime

import pytest

from fundlake.streaming import discovery

FOUND = "url string, title string"


@pytest.fixture
def place(tmp_path):
    return lambda name: f"file://{tmp_path}/{name}"


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, FOUND).coalesce(1).write.mode("append").parquet(folder)


def run(spark, place, **more):
    source = spark.readStream.schema(FOUND).option("maxFilesPerTrigger", 1).parquet(place("in"))
    q = discovery.watch_keyed(source, place("out"), place("checkpoint"), **more)
    q.awaitTermination(120)
    assert q.exception() is None
    return [p for p in q.recentProgress if p["numInputRows"]]


def urls(spark, place):
    return sorted(str(r.url) for r in spark.read.parquet(place("out")).collect())


def test_two_restarts(spark, place):
    arrive(spark, place("in"), [("a", "1"), ("a", "2"), (None, "x"), ("b", "1")])
    run(spark, place)
    assert urls(spark, place) == ["None", "a", "b"]
    arrive(spark, place("in"), [("b", "again"), ("c", "1"), (None, "y")])
    arrive(spark, place("in"), [("c", "again"), ("d", "1")])
    progress = run(spark, place)
    assert urls(spark, place) == ["None", "a", "b", "c", "d"]
    # Keys are in the state store, dealt by key; the table is not read.
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] == 5
    arrive(spark, place("in"), [("a", "3"), ("d", "3"), ("e", "1")])
    run(spark, place)
    assert urls(spark, place) == ["None", "a", "b", "c", "d", "e"]
    assert run(spark, place) == []


def test_a_batch_run_again_adds_nothing(spark, place, tmp_path):
    """A batch that was written but not marked as done, as after a crash, is run again."""
    arrive(spark, place("in"), [("a", "1"), ("b", "1")])
    run(spark, place)
    for mark in (tmp_path / "checkpoint" / "commits").iterdir():
        if mark.name.lstrip(".").split(".")[0] == "0":
            mark.unlink()
    run(spark, place)
    assert urls(spark, place) == ["a", "b"]


def test_known_table(spark, place):
    spark.createDataFrame([("a", "old"), (None, "old")], FOUND).write.parquet(place("known"))
    arrive(spark, place("in"), [("a", "1"), (None, "1"), ("b", "1")])
    run(spark, place, known=place("known"))
    assert urls(spark, place) == ["b"]


def test_forgotten_keys_are_news(spark, place):
    """A key is known for an hour of the stream's time."""
    timed = "url string, at timestamp"

    def more(*rows):
        spark.createDataFrame([(u, datetime.datetime(2026, 1, 1, h, m)) for u, h, m in rows], timed).coalesce(1).write.mode("append").parquet(place("in"))
        source = spark.readStream.schema(timed).option("maxFilesPerTrigger", 1).parquet(place("in"))
        q = discovery.watch_keyed(source, place("out"), place("checkpoint"), time="at", forget="1 hour")
        q.awaitTermination(120)
        return [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress]

    more(("a", 1, 0), ("a", 1, 5))
    more(("a", 1, 30), ("b", 1, 40))
    assert urls(spark, place) == ["a", "b"]
    assert more(("c", 9, 0))[-1] == 1  # what is older has left the state
    more(("a", 9, 10), ("b", 9, 20), ("b", 9, 30))
    assert urls(spark, place) == ["a", "a", "b", "b", "c"]


def test_as_batches(spark, place):
    rows = lambda *x: spark.createDataFrame([(u, "t") for u in x], FOUND)
    discovery.append_new(spark, rows("a", "b", "a"), place("t"))
    discovery.append_new(spark, rows("b", "c"), place("t"))
    assert sorted(r.url for r in spark.read.parquet(place("t")).collect()) == ["a", "b", "c"]
