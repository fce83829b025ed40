"""Names that meet by keys against tests of every pair; no plan has a join that tests them all."""

import difflib
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from fundlake.functions import likeness
from fundlake.functions.names import clean_name
from fundlake.operators import alike, contain, curation, merge, resolve
from fundlake.plans import analytics, matching, reports  # noqa: F401  (they register their queries)
from fundlake.plans.registry import QUERIES

DATA = "/root/testdata/sf0.001"


def made(letters, most, n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(letters) for _ in range(r.randint(0, most))) for _ in range(n)]


def names(spark, values):
    return spark.createDataFrame([(x,) for x in values], "name string")


def funds(spark, values, column="name"):
    return spark.createDataFrame(list(enumerate(values)), f"id long, {column} string")


@pytest.mark.parametrize("letters", ["ab", "ab c", "abcdefgh é"])
def test_holding(spark, letters):
    parts, wholes = [*made(letters, 9, 120, 1), None, "", "a", "a"], [*made(letters, 14, 150, 2), None, "", "aaaa", "aaaa"]
    got = contain.holding(spark.createDataFrame([(x,) for x in parts], "part string"), spark.createDataFrame([(x,) for x in wholes], "whole string")).collect()
    assert len(got) == len(set(got))
    assert {tuple(x) for x in got} == {(x, y) for x in parts if x is not None for y in wholes if y is not None and x in y}


def test_holding_of_nothing(spark):
    none, some = spark.createDataFrame([], "part string"), spark.createDataFrame([("x",)], "whole string")
    assert contain.holding(none, some).collect() == []
    assert contain.holding(some.toDF("part"), none.toDF("whole")).collect() == []


def test_a_frequent_run_is_dealt_out(spark):
    """All wholes hold the only run that a part can ask for."""
    wholes = spark.range(3000).select(F.concat(F.lit("fonds "), F.col("id").cast("string")).alias("whole"))
    parts = spark.createDataFrame([("fond",), ("f",), ("onds 29",)], "part string")
    met = contain.holding(parts, wholes)
    assert {r["part"]: r["count"] for r in met.groupBy("part").count().collect()} == {"fond": 3000, "f": 3000, "onds 29": 111}


@pytest.mark.parametrize(("few", "letters"), [(0, "ab c"), (0, "abcdefgh é"), (400, "ab"), (1500, "ab c")])
def test_holding_of_many(spark, monkeypatch, few, letters):
    """Texts too many to go to every task, or only some sizes of them; no exploded table is broadcast, whatever Spark takes it for."""
    monkeypatch.setattr(contain, "FEW", few)
    parts, wholes = [*made(letters, 9, 120, 21), None, "", "a"], [*made(letters, 14, 150, 22), None, "", "aaaaaaaa"]
    met = contain.holding(spark.createDataFrame([(x,) for x in parts], "part string"), spark.createDataFrame([(x,) for x in wholes], "whole string"))
    got = met.collect()
    assert len(got) == len(set(got))
    assert {tuple(x) for x in got} == {(x, y) for x in parts if x is not None for y in wholes if y is not None and x in y}
    if few == 0:
        assert "Broadcast" not in met._jdf.queryExecution().executedPlan().toString()


def test_contained_pairs(spark):
    wanted = [*made("ab c", 9, 150, 4), "Stichting abcabc", "abcabc", None, "ab", "ab"]
    own = [*made("ab c", 9, 150, 5), "abcabc pensioenfonds", None, "ab", ""]
    clean = lambda x: x.lower().replace("pensioenfonds", "").replace("stichting", "").strip()
    for least in (0, 2, 5):
        rule = lambda x, y: x == y or (len(x) > least and x in y) or (len(y) > least and y in x)  # noqa: B023, E731
        got = resolve.contained_pairs(names(spark, wanted).distinct(), funds(spark, own, "fund"), clean_name, least)
        assert {tuple(x) for x in got.collect()} == {(x, i) for x in wanted if x is not None for i, y in enumerate(own) if y is not None and rule(clean(x), clean(y))}


def first(hits, wanted):
    """The smallest id of the first rule that has any."""
    return {x: next((min(h) for h in hits(x) if h), None) if x is not None else None for x in wanted}


def test_rules(spark):
    wanted = [*made("Aab (/", 9, 200, 6), None, "", "a/b//", "ab (x)", "kring abba"]
    own = [*made("aAb (/", 8, 60, 7), None, "ab", "AB", "abba x"]
    f = [(i, y) for i, y in enumerate(own) if y is not None]
    table, ids = names(spark, wanted), funds(spark, own)
    got = lambda df: dict(tuple(r) for r in df.select("name", "id").collect())
    low = lambda x: x.lower()

    packed = lambda x: low(x).replace("pensioenfonds", "").replace("stichting", "").replace(" ", "")
    core = lambda x: re.split(r"\s+", x)[0].lower().replace("kring", "")
    planned = first(lambda x: ([i for i, y in f if len(packed(y)) > 4 and packed(y) in packed(x)], [i for i, y in f if len(core(x)) > 3 and core(x) in low(y)]), wanted)
    assert got(resolve.match_planning(table, ids)) == planned

    assert got(resolve.match_like(table, ids)) == first(lambda x: ([i for i, y in f if low(x) in low(y)],), wanted)

    def unique(x):
        only = lambda part: h if len(h := [i for i, y in f if low(part) in low(y)]) == 1 else []
        yield [i for i, y in f if x == y]
        yield only(x) if x else []
        yield [i for i, y in f if low(x) == low(y)]
        yield only(x.split("(")[0].rstrip(" ")) if "(" in x and x.split("(")[0].rstrip(" ") else []
        yield next((h for part in x.split("/") if (h := only(part.strip(" ")))), []) if "/" in x else []

    assert got(resolve.match_unique(table, ids)) == first(unique, wanted)

    pairs = {tuple(r) for r in resolve.match_short(table, ids).collect()}
    assert pairs == {(x, i) for x in wanted if x is not None and len(x) > 3 for i, y in f if low(x) in low(y) or low(y) in low(x)}

    known = ids.withColumn("ratio", F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 3 - 1.0))
    for some in (known, known.where("length(name) > 3")):
        held = [y for i, y in f if i % 3 == 2 and (some is known or len(y) > 3)]
        left = {r.name for r in resolve.unmatched(table, some).collect()}
        assert left == {x for x in wanted if x is None or not any(low(x) in low(y) or low(y) in low(x) for y in held)}


def test_row_alias(spark):
    r = random.Random(8)
    own = [(i, x) for i, x in enumerate([*made("ab c", 8, 60, 9), None, ""])]
    rows = [(i, x, [f"c{i}"]) for i, x in enumerate([*made("aB c", 8, 60, 10), None, "abc"])]
    aliases = [("ab", "ca"), ("b c", "a"), ("c", "bbb"), ("zz", "a")]
    got = curation.by_row_alias(spark.createDataFrame(own, "id long, name string"), spark.createDataFrame(rows, "row_no long, label string, cells array<string>"), spark.createDataFrame(aliases, "in_name string, in_row string"))
    expected = {}
    for i, name in own:
        if name is None:
            continue
        n, hits = name.lower(), [[], []]
        for k, label, cells in rows:
            if label is None:
                continue
            x, a, b = label.lower(), label.lower().strip(), n.strip()
            if any(p in n and q in x for p, q in aliases):
                hits[0].append((k, cells))
            if a == b or (len(a) > 3 and a in b) or (len(b) > 3 and b in a):
                hits[1].append((k, cells))
        if best := hits[0] or hits[1]:
            expected[i] = max(best)[1]
    assert {x.id: x.cells for x in got.collect()} == expected
    assert r  # names are made from seeds


def test_match_file(spark):
    own = [*made("ab cde f", 16, 80, 11), "abcde fffff", "Abcde", "xx", None, ""]
    paths = ["/" + x.replace(" ", "-") for x in made("abCde f", 14, 80, 12)] + ["/abcde-fffff.pdf", "/abcde-fffff.pdf"]
    got = dict(tuple(r) for r in resolve.match_file(funds(spark, own), spark.createDataFrame([(x,) for x in paths], "path string")).collect())
    expected = {}
    for i, name in enumerate(own):
        words = [w for w in re.split(r"[^a-z0-9]+", (name or "").lower()) if len(w) > 2]
        full = [p for p in paths if words and all(w in p.lower() for w in words)]
        some = [p for p in paths if any(w in p.lower() for w in words if len(w) > 4)]
        if full or some:
            expected[i] = min(full or some)
    assert got == expected


def test_update_like(spark):
    values = [*made("aB%_c", 7, 150, 13), None, "", "a%b", "aXXb", "back\\slash"]
    patterns = [("a_b", 1.0, 1), ("B%c", 2.0, 2), ("cc", 3.0, 3), ("a\\%b", 4.0, 4), ("ac", None, 5), ("back\\\\s", 6.0, 6)]
    for some in (patterns, [*patterns, ("%", 9.0, 0)]):
        table = spark.createDataFrame([(i, x, -1.0) for i, x in enumerate(values)], "id long, name string, v double")
        got = {r.id: r.v for r in merge.update_like(table, spark.createDataFrame(some, "pattern string, value double, ord int"), "name", "v").collect()}

        def like(pattern):
            out, escaped = "", False
            for c in pattern:
                out, escaped = (out + re.escape(c), False) if escaped else (out, True) if c == "\\" else (out + {"%": ".*", "_": "."}.get(c, re.escape(c)), False)
            return re.compile(out, re.IGNORECASE | re.DOTALL)

        expected = {}
        for i, x in enumerate(values):
            hits = [(o, v) for p, v, o in some if x is not None and like(p).search(x)]
            expected[i] = max(hits, key=lambda h: h[0])[1] if hits else -1.0
        assert got == expected


def test_ratio(spark):
    pairs = list(zip(made("abcde éA\U0001f600", 25, 400, 14), made("abcde éA\U0001f600", 25, 400, 15), strict=True))
    pairs += [(None, "x"), ("x", None), ("", ""), ("", "a"), ("Abc", "abd"), ("a" * 60, "a" * 41), ("ab" * 40, "ba" * 33), ("pensioenfonds metaal", "Stichting Pensioenfonds voor de Metaal")]
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", likeness.ratio(F.col("a"), F.col("b")).alias("s")).collect()
    for r in got:
        assert r.s == (None if r.a is None or r.b is None else difflib.SequenceMatcher(None, r.a.lower(), r.b.lower(), autojunk=False).ratio())


@pytest.mark.parametrize(("letters", "least"), [("abc d", 0.65), ("abcdefghijk", 0.5), ("etaoin shrdlu", 0.65), ("ab", 0.9)])
def test_alike(spark, letters, least):
    left, right = [*made(letters, 14, 70, 16), ""], [*made(letters, 14, 70, 17), ""]
    frame = lambda v, c: spark.createDataFrame([(x,) for x in v], f"{c} string")
    got = alike.alike(frame(left, "a"), frame(right, "b"), least).collect()
    ratio = lambda x, y: difflib.SequenceMatcher(None, x, y, autojunk=False).ratio()
    assert len(got) == len({(r.a, r.b) for r in got})
    assert {tuple(r) for r in got} == {(x, y, ratio(x, y)) for x in set(left) for y in set(right) if x and y and ratio(x, y) > least}


def test_fuzzy(spark):
    wanted, own = [*made("abcd e", 12, 60, 18), None, "", "ABC"], [*made("abcd e", 12, 60, 19), None, "abc", "abc"]
    f = [(i, y.lower()) for i, y in enumerate(own) if y is not None]
    got = {r.name: (r.id, r.score) for r in resolve.match_fuzzy(names(spark, wanted), funds(spark, own)).collect()}
    for x in set(wanted):
        expected = (None, None)
        if x is not None:
            n = x.lower()
            sure = [i for i, y in f if n == y], [i for i, y in f if n in y], [i for i, y in f if y in n]
            if any(sure):
                expected = min(next(h for h in sure if h)), None
            else:
                scored = [(difflib.SequenceMatcher(None, n, y, autojunk=False).ratio(), -i) for i, y in f]
                if (best := max(scored))[0] > 0.65:
                    expected = -best[1], best[0]
        assert got[x] == expected


KEYED = "q_match_planning q_match_short q_unmatched q_row_alias q_like_first q_match_unique q_enriched q_match_file q_update_like q_fuzzy q_containment_match q_manual_patches".split()


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables aren't here")
@pytest.mark.parametrize("name", KEYED)
def test_no_plan_tests_all_pairs(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables aren't here")
@pytest.mark.parametrize("name", "q_match_planning q_match_unique q_match_file".split())
def test_no_plan_broadcasts_many_names(spark, monkeypatch, name):
    """Spark takes these tables for small, by their files."""
    monkeypatch.setattr(contain, "FEW", 0)
    assert "Broadcast" not in QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
