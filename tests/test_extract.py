"""Extractors on short report texts."""

import os

import pytest
from pyspark.sql import functions as F

from fundlake.operators import extract as X
from fundlake.operators.layout import key_figures
from fundlake.operators.regions import pivot_weights, regional_weights
from fundlake.plans import reports  # noqa: F401
from fundlake.plans.registry import QUERIES


def one(spark, f, text):
    return spark.createDataFrame([(text,)], "t string").select(f(F.col("t")).alias("v")).first().v


@pytest.mark.parametrize(
    ("f", "text", "expected"),
    [
        (X.equity_share, "aandelen 0% en 35,5 %", 35.5),
        (X.equity_share, "geen", None),
        (X.equity_share, None, None),
        (X.equity_share_patterned, "aandelen: 3% ... 45,5% in aandelen", 45.5),
        (X.equity_share_of_page, "Aandelenfondsen: circa 30,5 %", 30.5),
        (X.equity_share_of_snippet, "wij hebben 31% aandelen en 40% aandelen", 31.0),
        (X.regions_named, "aandelen wereldwijd, europa en usa; " + "nederland " * 2, "Global, Europe, North America"),
        (X.regions_named, "aandelen in europa, usa en nederland", "Global, Europe, North America"),
        (lambda t: X.weights_text(X.region_weights(t)), "aandelen: europa 22,5% en 40% noord-amerika, japan (7%)", "North America: 7.0, Europe: 22.5, Pacific/Other: 7.0"),
        (X.management_style, "de aandelen worden passief beheerd en volgen passief", "Passive"),
        (X.management_style, "geen woord", None),
        (X.factor_style, "geen factorbeleggen", "No"),
        (X.factor_style, "value value value value van aandelen", "Yes (Mentions Factor Investing)"),
        (X.esg_focus, "esg " * 11, "Medium (Mentions ESG/Exclusions)"),
        (lambda t: X.coverage_ratio(t, X.COVERAGE["maanddekkingsgraad_pct"]), "actuele dekkingsgraad was 45% en later 115,3%", None),
        (lambda t: X.coverage_ratio(t, X.COVERAGE["maanddekkingsgraad_pct"]), "dekkingsgraad ultimo 115,3 %", 115.3),
        (lambda t: X.participants(t, X.PARTICIPANTS["deelnemers_actief"]), "2024 actieve deelnemers 12.345 slapers 3.000", 12345),
        (lambda t: X.participants(t, X.PARTICIPANTS["deelnemers_slapers"]), "3.000 slapers in 2024", 3000),
        (X.cost_per_participant, "kosten per deelnemer 2023 € 215 euro", 215.0),
        (X.total_cost, "totale uitvoeringskosten 1.483 duizend", 1.483),
        (lambda t: X.cost_ratio(t, X.COST_RATIOS["vermogensbeheerkosten"]), "vermogensbeheerkosten 35 bps", "0.350%"),
        (lambda t: X.cost_ratio(t, X.COST_RATIOS["transactiekosten"]), "niets", "Unknown"),
        (X.asset_mix, "beleggingsmix: aandelen 30,1%, vastrentend 50,2%, vastgoed 9,9%", "Aandelen: 30,1% | Vastrentend: 50,2% | Vastgoed: 9,9%"),
        (X.asset_mix, "de beleggingsmix", "Mentions mix but exact % parsed failed"),
        (lambda t: X.asset_mix(t, relaxed=True), "portefeuille aandelen 30,1", "Aandelen: 30,1%"),
        (lambda t: X.asset_class(t, X.CLASSES["real_estate_pct"]), "Vastgoed (direct) 9,5 %", 9.5),
        (X.assets_of_report, "balanstotaal 5.400 miljoen", 5.4),
        (X.assets_patterned, "belegd vermogen: 1.871.783.000", 1.871783),
        (X.assets_of_lines, "Belegd vermogen\n285.340", 285.34),
        (X.assets_of_snippets, "vermogen 0,001 miljard; beheer 2,4 miljard", 2.4),
        (X.assets_of_page, "Belegd vermogen van ruim € 120 miljoen", 0.12),
        (X.largest_amount, "totaal vermogen 2 mld en belegd vermogen 3 mld", 3.0),
        (X.performance_fee, "performance fee\n1.250.000", 1.25),
        (X.performance_fee, "performance fee bedroeg 12345 euro", 12.34),
        (X.performance_fee, "performance fee bedroeg 12345.250.000 euro", 12345.25),
        (X.benchmarks, "als benchmark de msci world index en ftse epra index.", "Ftse Epra Index, Msci World Index"),
        (X.benchmarks, "niets", "None explicitly identified"),
        (X.report_year, "over 2023 jaarverslag", 2023),
        (X.report_year, "2021 2022 2022", 2022),
        (lambda t: X.indexation_of_window(t, "actiev|opbouwend"), "toeslag voor actieven 2,5% en gewezen 1,0%", "2,5"),
        (X.indexation_of_site, "indexatie van 15%; verhoogd met 3,2 %", 3.2),
        (X.administrator, "De pensioenuitvoerder is APG Groep, te Heerlen", "APG Groep"),
        (X.administrator, "administratie door TKP", "TKP"),
        (X.managed_internally, "wij doen geen intern beheer", "Nee"),
        (X.managed_internally, "alles in eigen beheer", "Ja"),
        (X.protection, "Eerst. Wij kopen een optie tegen risico. Daarna. Los.", "Eerst. Wij kopen een optie tegen risico. Daarna."),
        (X.protection, "Niets.", "Unknown"),
        (X.sfdr_class, "Art. 8 SFDR", "Artikel 8 (Lichtgroen)"),
        (X.sfdr_class, "donkergroen", "Artikel 9 (Donkergroen)"),
        (X.exclusions, "tabak en kernwapens", "Tabak, Controversiële Wapens"),
        (X.co2_goal, "CO2: 50% reductie in 2030", "50% reductie in 2030"),
        (X.co2_goal, "reductie van 40 % minder CO2 voor 2035", "40% reductie in 2035"),
        (X.fund_line, "Corporate funds", "header"),
        (X.fund_line, "BPL Pensioen", "fund"),
        (X.fund_line, "zomaar", None),
    ],
)
def test_extract(spark, f, text, expected):
    assert one(spark, f, text) == expected


def test_strategy_notes(spark):
    long = lambda w, n: f"het beleggingsbeleid {w} " + "x" * n
    text = "\n".join([long("a", 80), "kort beleid aandelen", long("b", 200), long("c", 100), long("d", 90)])
    got = one(spark, X.strategy_notes, text).split(" | ")
    assert [x.split()[2] for x in got] == ["b", "c", "d"]


def test_structs(spark):
    r = one(spark, X.transition_row, "Foodservice 2027 (april) Van 1-1-2026 naar 1-4-2027solidair ja 62,493AZL")
    assert tuple(r) == ("Foodservice", "2027 (april)", "solidair", "ja", 62, "AZL")
    assert one(spark, X.transition_row, "Naam fonds") is None
    assert tuple(one(spark, X.person, "J. Smit (Voorzitter)")) == ("J. Smit", "J. Smit (Voorzitter)")
    assert tuple(one(spark, X.person, "Bestuurslid: Jane Doe")) == ("Jane Doe", "Bestuurslid: Jane Doe")
    assert one(spark, X.person, "Jan de Vries (lid)") is None
    assert tuple(one(spark, X.snippet_traits, "actief en passief, 30% aandelen, esg, europa")) == (30.0, "Mixed", None, "Yes", "Europe")
    assert tuple(one(spark, X.snippet_metrics, "8,1 mrd; dekkingsgraad 110,5%")) == (8.1, 110.5)


def test_link_tests(spark):
    df = spark.createDataFrame([("https://a.nl/nieuws/x", "https://a.nl/"), ("https://a.nl/nieuws/", "https://a.nl/"), ("https://a.nl/v.PDF", "p")], "u string, p string")
    assert [r.k for r in df.select(X.link_type(F.col("u"), F.col("p")).alias("k")).collect()] == ["news", None, "document"]
    links = spark.createDataFrame([("/jaarverslag-2023.pdf", "x"), ("/jaarverslag-2019.pdf", "x"), ("/mvo.pdf", "Rapport"), ("/transitieplan.pdf", "")], "h string, t string")
    got = links.select(X.is_report_link(F.col("h"), F.col("t")).alias("a"), X.is_esg_link(F.col("h"), F.col("t")).alias("b"), X.is_transition_link(F.col("h"), F.col("h")).alias("c")).collect()
    assert [tuple(r) for r in got] == [(True, False, False), (False, False, False), (False, True, False), (False, False, True)]


def test_regional_weights(spark):
    rows = [(1, "North America: 40.0, Europe: 40.0", None), (2, "Europe: 95.0", "Global"), (3, None, "Europe, Emerging Markets"), (4, "", "Global, Netherlands"), (5, None, None)]
    got = {}
    for r in regional_weights(spark.createDataFrame(rows, "fund_id long, explicit_geographic_weights string, geographic_allocation string")).collect():
        got.setdefault(r.fund_id, {})[r.region] = r.weight_pct
    assert got == {1: {"North America": 50.0, "Europe": 50.0}, 2: {"Europe": 95.0}, 3: {"Europe": 59.26, "Emerging Markets": 40.74}, 4: {"North America": 63.0, "Europe": 16.0, "Emerging Markets": 11.0, "Other": 10.0}}
    twice = spark.createDataFrame([(1, "A", 1.0), (1, "A", 2.0)], "f int, region string, weight_pct double")
    with pytest.raises(Exception, match="duplicate"):
        pivot_weights(twice, "f", ["A"]).collect()


def test_key_figures_of_every_order(spark):
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("the driver's tables aren't here")
    orders = {r[0] for r in spark.read.parquet(f"{path}/orders.parquet").select("o_orderkey").collect()}
    assert {r.doc_id for r in QUERIES["q_key_figures"](spark, path).collect()} == orders


def test_key_figures(spark):
    rows = [(10.0, 5.0, "Meerjarenoverzicht"), (100.0, 50.0, "2023"), (200.0, 51.0, "2022"), (300.0, 49.0, "2021"), (10.0, 80.0, "Beleidsdekkingsgraad"), (110.0, 81.0, "115,5%"), (150.0, 79.0, "101,1"), (290.0, 80.0, "99"), (10.0, 20.0, "CPI 5"), (100.0, 20.0, "7")]
    spans = spark.createDataFrame([(1, 0, *r) for r in rows] + [(2, 0, *r) for r in rows[:3]], "doc_id long, page_no int, x double, y double, text string")
    got = {(r.doc_id, r.year): r.beleidsdekkingsgraad_pct for r in key_figures(spans).collect()}
    assert got == {(1, 2023): 115.5, (1, 2021): 99.0}
