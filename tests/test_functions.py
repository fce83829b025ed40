"""Column functions: hand-traced values, nulls and odd input."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from fundlake.functions import dates, names
from fundlake.functions import numbers as N
from fundlake.functions import text as X


def values(spark, f, inputs, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, s {kind}")
    return [r.v for r in df.select("i", f(F.col("s")).alias("v")).orderBy("i").collect()]


@pytest.mark.parametrize(
    ("f", "inputs", "expected"),
    [
        (N.comma_decimal, ["45,5", "1.250", "1.250,5", "", None, "x"], [45.5, 1.25, None, None, None, None]),
        (N.dotted_thousands, ["5.400", "12,5", "8.1", None], [5400.0, 12.5, 81.0, None]),
        (N.dutch_number, ["1.234,5", "1,234.5", "1.250", "1,5", "12,345", "7", None, "a"], [1234.5, 1234.5, 1250.0, 1.5, 12345.0, 7.0, None, None]),
        (N.count, ["2024", "9", "151.362", "1 200", "x", None], [None, None, 151362, 1200, None, None]),
        (N.coverage, ["115,3 %", "45%", "250", None], [115.3, None, 250.0, None]),
        (N.cost, ["0,61%", "Unknown", None], [0.61, None, None]),
        (N.first_decimal, ["kosten 0,35 en 1,2", "None", "12", None], [0.35, None, None, None]),
        (N.signed, ["-3,5%", "2 van 4", "geen"], [-3.5, 2.0, None]),
        (N.thousands, ["699,106", "3.013.496", "x", None], [699, 3013, None, None]),
        (N.last_token, ["Shell plc  1.234", "leeg", None], [1234, None, None]),
        (dates.dutch_date, ["3 mei 2026", "2026-05-03", "onbekend", "31 februari 2024", None, "12 december 2019 (do)"], [datetime.date(2026, 5, 3), datetime.date(2026, 5, 3), None, None, None, datetime.date(2019, 12, 12)]),
        (dates.year_suffix, ["Jaarverslag 2023", "Verslag", None, "x 12ab"], [2023, 0, None, 12]),
        (dates.leading_date, ["1-Apr-26 3 Mitt", "Mitt 1-apr-26"], ["1-apr-26", None]),
        (names.clean_name, ["Stichting Pensioenfonds ABP", " SPF X (gesloten) ", None], ["abp", "x", None]),
        (names.packed_name, ["Pensioenfonds Rail & OV"], ["rail&ov"]),
        (names.dutch_category, ["Sector", "Anders", None], ["Tak", "Anders", None]),
        (names.guessed_category, ["Kring A", "BPF Bouw", "IFF", "x"], ["APF", "Tak", "Bedrijf", None]),
        (names.with_scheme, ["a.nl", "http://a.nl"], ["https://a.nl", "http://a.nl"]),
        (X.title_case, ["msci world-index s&p", None], ["Msci World-Index S&P", None]),
        (X.squeeze, [" a \n  b "], ["a b"]),
    ],
)
def test_values(spark, f, inputs, expected):
    assert values(spark, f, inputs) == expected


def test_magnitudes(spark):
    assert values(spark, N.millions, [2500000.0, 2500.0, 950.0], "double") == [2.5, 2.5, 950.0]
    assert values(spark, N.basis_points, [35.0, None], "double") == ["0.350%", None]
    assert values(spark, N.total_cost, [50.0, 2024.0, 5000.0, 2e6, 0.0], "double") == [50.0, None, 5.0, 2.0, None]


def test_windows_of_a_long_text(spark):
    """A megabyte with tens of thousands of matches, each window against slices of the text."""
    text = "".join(f"é{i} aandelen " for i in range(70000))
    at = [m.start() for m in re.finditer("aandelen", text)]
    got = spark.createDataFrame([(text,)], "t string").select(X.windows(F.col("t"), "aandelen", 30, 1500).alias("w")).first().w
    assert len(got) == len(at) and got[::997] == [text[max(i - 30, 0) : i + 8 + 1500] for i in at[::997]]


def test_windows_overlap_and_stay_in_the_text(spark):
    got = values(spark, lambda c: X.keyword_windows(c, ["ab", "b."], 2, 3), ["xabab.y", "", None])
    assert got == [["xabab.", "abab.y", "bab.y"], [], []] or got == [["xabab.", "abab.y", "bab.y"], [], None]
    assert values(spark, lambda c: X.windows(c, "a", 0, 2, own=False), ["abcabc"]) == [["bc", "bc"]]
    assert values(spark, lambda c: X.windows(c, "c", 2, 0, own=False), ["abcabc"]) == [["ab", "ab"]]


@pytest.mark.parametrize(
    ("base", "href", "expected"),
    [
        ("https://a.nl/x/y.html", "z.html", "https://a.nl/x/z.html"),
        ("https://a.nl/x/y.html", "/z", "https://a.nl/z"),
        ("https://a.nl", "z", "https://a.nl/z"),
        ("https://a.nl/x/y/q", "../z", "https://a.nl/x/z"),
        ("https://a.nl/x", "//b.nl/c", "https://b.nl/c"),
        ("https://a.nl/x", "http://c.nl/d", "http://c.nl/d"),
        ("https://a.nl/x?q=1", "#top", "https://a.nl/x?q=1#top"),
    ],
)
def test_resolve(spark, base, href, expected):
    assert spark.range(1).select(names.resolve(F.lit(base), F.lit(href)).alias("u")).first().u == expected


def test_site_score(spark):
    s = spark.range(1).select(names.site_score(F.lit("https://www.pensioenfondsabp.nl/"), F.lit("ABP")).alias("a"), names.site_score(F.lit("https://kvk.nl/abp"), F.lit("ABP")).alias("b"), names.site_score(F.lit("https://x.com/a/b"), F.lit("ABP")).alias("c")).first()
    assert (s.a, s.b, s.c) == (75, -100, -6)
