"""Extractors over the table of annotations against the same ones over texts."""

import random

import pytest
from pyspark.sql import functions as F

from fundlake.operators import annotate as A
from fundlake.operators import extract as X

DOCS = "doc_id long, text string"


def made():
    r = random.Random(1)
    words = [*A.VOCABULARY, *X.REGIONS, "45%", "5,5 %", "100%", "12", "7%", "0%", "x", "\n", "beheer", "tekst", "Aandelen", "AZIË"]
    rows = [" ".join(r.choice(words) for _ in range(r.randint(0, 60))).replace(" ", r.choice([" ", "", " ", "  "])) for _ in range(300)]
    rows += [("tekst " * r.randint(0, 80)).join(r.choice(words) for _ in range(30)) for _ in range(80)]
    return list(enumerate([*rows, None, "", "%", "europees" + "x" * 26 + " 5%", "europe" + "x" * 30 + "5%", "aandelen 5%" + "x" * 30 + "europa", "aandelen 5%" + "x" * 31 + "europa"]))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(made(), DOCS).repartition(4).cache()


@pytest.fixture(scope="module")
def marks(docs):
    return A.annotations(docs, by="doc_id").cache()


def test_every_place_of_every_word(marks):
    got = {}
    for x in marks.where("kind = 'word'").collect():
        got.setdefault(x.doc_id, set()).add((x.start, x.end, x.word))
    for i, text in made():
        t = (text or "").lower()
        assert got.get(i, set()) == {(s, s + len(w), w) for w in A.VOCABULARY for s in range(len(t)) if t.startswith(w, s)}


@pytest.mark.parametrize(("new", "old"), [(A.regions_named, X.regions_named), (A.region_weights, X.region_weights), (A.management_style, X.management_style)])
def test_same_as_over_texts(docs, marks, new, old):
    got = {r.doc_id: r[1] for r in new(marks).collect()}
    assert got == {r.doc_id: r.v for r in docs.select("doc_id", old(F.lower("text")).alias("v")).collect() if r.v is not None}
    assert len(got) > 50


def test_stored_by_document_there_is_no_other_shuffle(spark):
    stored = A.annotations(spark.createDataFrame([(1, "aandelen")], DOCS), by="doc_id")
    for f in (A.regions_named, A.region_weights):
        assert f(stored)._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1


def test_places(spark):
    rows = ["", None, "aa", "aaab", "xaab", "baaa\U0001f600aa"]
    got = spark.createDataFrame([(x,) for x in rows], "t string").select("t", A.places(F.col("t"), "a+b?").alias("p")).collect()
    import re

    for x in got:
        assert [(p.start, p.found) for p in x.p] == [(m.start(), m[1]) for m in re.finditer("(?=(a+b?))", x.t or "")]


def test_a_document_of_many_windows(spark):
    """Time in proportion to the annotations: 40,000 windows, each with thousands of others in reach."""
    text = "aandelen europa 5% passief " * 40_000
    marks = A.annotations(spark.createDataFrame([(1, text)], DOCS), by="doc_id").cache()
    assert A.regions_named(marks).first().regions == "Europe"
    assert [tuple(w) for w in A.region_weights(marks).first().weights] == [("Europe", 5.0)]
    assert A.management_style(marks).first().style == "Passive"
