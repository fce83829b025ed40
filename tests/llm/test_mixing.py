"""Targets with repeated rows, null ids, one source of one text, very long texts."""

import random

import pytest

from fundlake.llm import mixing

DOCS = "doc_id long, text string, source string"


def told(spark, rows, parts=3):
    """Of each source: target, taken, and the size of its largest document."""
    out = {}
    for r in mixing.mix_sources(spark.createDataFrame(rows, DOCS).repartition(parts)).collect():
        target, taken, largest = out.get(r.source, (r.target, 0, 0))
        out[r.source] = target, taken + r.taken, max(largest, r.size)
        assert r.taken <= 3 * r.size and r.taken == r.size * r.copies
    return out


def near(spark, rows):
    found = told(spark, rows)
    for target, taken, largest in found.values():
        assert abs(taken - target) <= largest, found
    return found


def test_a_third_of_one_row(spark):
    r = random.Random(1)
    words = lambda n: " ".join(r.choice("abcdefgh") for _ in range(n))
    near(spark, [(1, "ten words in this one text here, all the same", "s1")] * 400 + [(i, words(10), "s2") for i in range(2, 602)])
    near(spark, [(None, "a b c d e f g h i j", "s1")] * 400 + [(i, words(10), "s2") for i in range(600)])


def test_sources_of_one_row_each(spark):
    found = near(spark, [(1, "a b c", "s1")] * 100 + [(2, "a b c", "s2")] * 100 + [(3, "a b c d e", "s3")] * 35)
    assert {k: v[0] for k, v in found.items()} == pytest.approx({"s1": 484.375, "s2": 193.75, "s3": 96.875})


def test_many_heavy_groups_are_met_in_tasks(spark, monkeypatch):
    rows = [(i % 5, f"text {i % 5} of some words", "s1") for i in range(300)] + [(i, f"one {i} more", "s2") for i in range(300)]
    whole = sorted(tuple(r) for r in mixing.mix_sources(spark.createDataFrame(rows, DOCS)).collect())
    monkeypatch.setattr(mixing, "MAX_SOURCES", 1)
    assert sorted(tuple(r) for r in mixing.mix_sources(spark.createDataFrame(rows, DOCS)).collect()) == whole


def test_reruns_agree(spark, tmp_path):
    rows = [(1, "same text again", "s1")] * 200 + [(i, f"text {i} " * (i % 7), "s2") for i in range(300)] + [(None, None, None), (5, "", None)]
    spark.createDataFrame(rows, DOCS).repartition(5).write.parquet(f"file://{tmp_path}/d")
    runs = [sorted(map(str, mixing.mix_sources(spark.read.parquet(f"file://{tmp_path}/d")).collect())) for _ in range(2)]
    assert runs[0] == runs[1]


def test_very_long_text(spark):
    near(spark, [(1, "word " * 300_000, "s1"), (2, "word " * 10, "s1")] + [(i, "other words here", "s2") for i in range(3, 900)])
