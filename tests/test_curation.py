"""Curation steps, exports and the catalog."""

import pytest
from pyspark.sql import functions as F

from fundlake.catalog import Catalog
from fundlake.operators import curation as C
from fundlake.plans import export as E
from fundlake.sources import documents as D


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_lines_and_lists(spark):
    pages = spark.createDataFrame([(1, 0, "iets\nAandelen\n99,5%\n30,5 %"), (2, 0, "zakelijke waarden 45% x"), (3, 0, "aandelen\nniets")], "doc_id long, page_no int, text string")
    assert rows(C.equity_share_of_lines(pages)) == [(1, 30.5), (2, 45.0)]
    lines = spark.createDataFrame([("d", i, x) for i, x in enumerate(["los", "1-apr-26 3 Mitt AZL", "PostNL TKP Ja", "1-jan-27 2 ING", "Totaal: 3", "later"])], "doc_id string, line_no int, line string")
    assert [r[2:] for r in rows(C.planning_list(lines))] == [("1-apr-26", "Mitt AZL"), ("1-apr-26", "PostNL TKP Ja"), ("1-jan-27", "ING")]
    book = spark.createDataFrame([("d", i, x) for i, x in enumerate(["BPL Pensioen", "Corporate", "Stichting Pensioenfonds X", "zomaar"])], "doc_id string, line_no int, line string")
    assert [r[2:] for r in rows(C.directory(book))] == [("BPL Pensioen", "General"), ("Stichting Pensioenfonds X", "Corporate")]
    flat = spark.createDataFrame([("2023 2022 2021\nrendement 5,1% -3,2 4",)], "t string").select(C.flat_figures(F.col("t"), "rendement").alias("v")).first().v
    assert [tuple(x) for x in flat] == [("2023", 5.1), ("2022", -3.2), ("2021", 4.0)]


def test_regulator(spark):
    funds = spark.createDataFrame([(1, "Pensioenfonds Alpha", "x", 1.0), (2, "Beta (gesloten)", "x", 2.0)], "id long, name string, data_source string, ratio double")
    sheet = spark.createDataFrame([("Alpha", 110.0), ("Gamma fonds", 99.0)], "name string, ratio double")
    assert rows(C.merge_regulator(funds, sheet, ["ratio"])) == [(1, "Pensioenfonds Alpha", "x", 110.0), (2, "Beta (gesloten)", "x", 2.0), (3, "Gamma fonds", "DNB Appendix", 99.0)]
    assert [r.status for r in C.status_of(funds, spark.createDataFrame([("nergens",)], "name string")).orderBy("id").collect()] == ["Open", "Gesloten"]


def test_aliases_fees_walks_gaps(spark):
    funds = spark.createDataFrame([(1, "Shell"), (2, "KLM Cabine"), (9, "Onbekend")], "id long, name string")
    table = spark.createDataFrame([(0, "Shell Pensioen", ["a"]), (1, "shell", ["b"]), (2, "cabinepersoneel", ["c"])], "row_no int, label string, cells array<string>")
    alias = spark.createDataFrame([("klm cabine", "cabinepersoneel")], "in_name string, in_row string")
    assert rows(C.by_row_alias(funds, table, alias)) == [(1, ["b"]), (2, ["c"])]
    grids = spark.createDataFrame([(1, 0, 0, [["x", "1"], ["Performance fee", "2", "2.500"]]), (2, 0, 0, [["x", "1"]])], "doc_id long, page_no int, table_no int, rows array<array<string>>")
    assert rows(C.table_fees(grids)) == [(1, 2.5)]
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "page string, url string")
    walked = C.walk_links(links, spark.createDataFrame([(1, "a")], "site int, url string"), most=3)
    assert rows(walked) == [(1, "a", 0), (1, "b", 1), (1, "c", 2)]
    files = spark.createDataFrame([("/x/1_a.pdf",), ("/x/2_b.pdf",), ("z.pdf",)], "path string")
    assert rows(C.unextracted(funds, spark.createDataFrame([(1,), (None,)], "fund_id long"), files)) == [(2, "KLM Cabine")]


def test_exports(spark, tmp_path):
    funds = spark.createDataFrame([(1, "A|x", "Tak", 1.25), (2, "B", None, None)], "id long, name string, category string, aum_euro_bn double")
    assert E.move_after(funds, "aum_euro_bn", "id").columns == ["id", "aum_euro_bn", "name", "category"]
    assert E.move_after(funds, "none", "id").columns == funds.columns
    lines = [r.line for r in E.markdown_table(funds, ["id", "name", "aum_euro_bn"], ["id"]).collect()]
    assert lines == ["| id | name | aum_euro_bn |", "|---|---|---|", "| 1 | Ax | 1.25 |", "| 2 | B | NaN |"]
    assert [r.v for r in funds.select("id", E.shown(F.col("aum_euro_bn"), decimals=1, suffix=" bn").alias("v")).orderBy("id").collect()] == ["1.2 bn", "-"]
    assert tuple(E.widths(funds).first()) == (3, 5, 5, 6)
    news = spark.createDataFrame([(1, "t")], "fund_id long, title string")
    assert rows(E.sheets({"funds": funds, "news": news})["news"]) == [("A|x", "t")]
    assert rows(E.pie(funds, "category")) == [("Tak", 1)] and E.scatter(funds, "id", "aum_euro_bn").count() == 1
    assert rows(E.word_rows(funds, ["id", "category"])) == [("1", "Tak"), ("2", "-")]
    E.write_csv(funds, f"file://{tmp_path}/c")
    assert D.csv(spark, f"file://{tmp_path}/c", "id long, name string, category string, aum_euro_bn double").count() == 2


def test_catalog(spark, tmp_path):
    c = Catalog(spark, f"file://{tmp_path}/db")
    c.create()
    c.create()
    one = spark.createDataFrame([(1, "Europe", 50.0)], "fund_id long, region string, weight_pct double")
    c.append("equity_strategies", one)
    c.replace("equity_strategies", c.table("equity_strategies").withColumn("weight_pct", F.lit(60.0)))
    assert rows(c.sql("SELECT region, weight_pct FROM equity_strategies WHERE fund_id = :id", {"id": 1})) == [("Europe", 60.0)]
    assert "funds" in c.names() and c.table("funds").count() == 0
