"""Merging, matching, sources, streaming and the stage runner."""


import pytest
from pyspark.sql import functions as F

from fundlake import schemas
from fundlake.operators import merge, resolve
from fundlake.plans import pipeline
from fundlake.sources import documents as D
from fundlake.sources import html
from fundlake.streaming import discovery

T = "k long, a string, v double"


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_updates(spark):
    t = spark.createDataFrame([(1, "x", 1.0), (2, "y", None), (3, "z", 3.0)], T)
    s = spark.createDataFrame([(1, "n", None), (2, "n", 20.0), (4, "n", 4.0)], T)
    assert rows(merge.update(t, s, ["k"], ["v"])) == [(1, "x", None), (2, "y", 20.0), (3, "z", 3.0)]
    assert rows(merge.update(t, s, ["k"], ["v"], "found")) == [(1, "x", 1.0), (2, "y", 20.0), (3, "z", 3.0)]
    assert rows(merge.update(t, s, ["k"], ["v"], "fill")) == [(1, "x", 1.0), (2, "y", 20.0), (3, "z", 3.0)]
    assert rows(merge.upsert(t, s, ["k"], ["v"])) == [(1, "x", None), (2, "y", 20.0), (3, "z", 3.0), (4, None, 4.0)]
    assert rows(merge.upsert_replace(t, s, ["k"])) == [(1, "n", None), (2, "n", 20.0), (3, "z", 3.0), (4, "n", 4.0)]
    assert rows(merge.insert_new(t, s.union(s), ["k"])) == [(4, "n", 4.0)]
    assert merge.filled(t, s, ["k"], "v").first().n_filled == 1
    assert rows(merge.last_by(s.union(spark.createDataFrame([(1, "m", 9.0)], T)), ["k"], ["a"]))[0] == (1, "n", None)
    assert merge.add_columns(t, v="double", w="int").columns == ["k", "a", "v", "w"]
    assert [r.status for r in merge.set_column(t, "status", "Open").collect()] == ["Open"] * 3


def test_merge_duplicates(spark):
    t = spark.createDataFrame([(1, "x", 1.0), (2, "d", 20.0), (3, "d", None), (4, "y", 4.0)], T)
    pairs = spark.createDataFrame([(2, 1), (3, 1)], "dup long, orig long")
    assert rows(merge.merge_duplicates(t, pairs, "k", ["v"])) == [(1, "x", 20.0), (4, "y", 4.0)]


def test_matching(spark):
    funds = spark.createDataFrame([(1, "Pensioenfonds PME"), (2, "Stichting Shell Pensioenfonds"), (3, "bpfBOUW"), (4, "Shell NL")], "id long, name string")
    wanted = spark.createDataFrame([("Shell Pensioenfonds",), ("Metalektro",), ("Bouwnijverheid",), ("Nergens",)], "name string")
    assert dict(rows(resolve.match_regulator(wanted, funds))) == {"Shell Pensioenfonds": 2, "Metalektro": 1, "Bouwnijverheid": 3, "Nergens": None}
    fuzzy = dict((r.name, r.id) for r in resolve.match_fuzzy(spark.createDataFrame([("bpfbouw",), ("Shel NL",), ("qqqqqqqq",)], "name string"), funds).collect())
    assert fuzzy == {"bpfbouw": 3, "Shel NL": 4, "qqqqqqqq": None}
    unique = dict(rows(resolve.match_unique(spark.createDataFrame([("Shell NL",), ("PME (x)",), ("Shell",), ("zz/PME",)], "name string"), funds)))
    assert unique == {"Shell NL": 4, "PME (x)": 1, "Shell": None, "zz/PME": 1}
    files = spark.createDataFrame([("1_b.pdf",), ("1_a.pdf",), ("12_c.pdf",)], "path string")
    assert rows(resolve.first_file(funds, files)) == [(1, "1_a.pdf")]
    named = spark.createDataFrame([("/x/stichting_shell_pensioenfonds.pdf",), ("/x/other.pdf",)], "path string")
    assert rows(resolve.match_file(funds, named).select("id")) == [(1,), (2,), (4,)]


def test_documents(spark):
    dump = spark.createDataFrame([("d", "== T ==\n--- PAGE 1 ---\neen\ntwee\n--- PAGE 2 ---\ndrie")], "doc_id string, text string")
    pages = D.split_pages(dump)
    assert rows(pages) == [("d", 1, "\neen\ntwee\n"), ("d", 2, "\ndrie")]
    assert rows(D.whole_text(pages, " ", lower=True)) == [("d", "\neen\ntwee\n \ndrie")]
    lines = D.lines(pages)
    assert lines.where("line = 'twee'").first().line_no == 2
    around = D.context(lines.where("page_no = 1"), ["doc_id"], "line_no", "line", 1, 0).where("line = 'twee'").first()
    assert around.context == "een twee"
    many = spark.createDataFrame([("d", i, "rendement " + "x" * 90) for i in range(60)], "doc_id string, page_no int, text string")
    kept = D.last_pages(many, ["rendement"], 50, 250).first().text
    assert kept.startswith("--- PAGE 57 ---") and kept.count("PAGE") == 3
    assert D.page_window(many, 2, 3, 4).first().text == "rend"
    spans = spark.createDataFrame([("d", 0, 5.0, 11.0, " b "), ("d", 0, 1.0, 9.0, "a")], "doc_id string, page_no int, x double, y double, text string")
    assert [i.text for i in D.layout_rows(spans).first()["items"]] == ["a", "b"]
    md = spark.createDataFrame([("m", i, x) for i, x in enumerate(["## A", "- **Equity Allocation:** 30.5%", "- **Strategy Notes:**", "> een", "> twee", "## B", "- **Equity Allocation:** Unknown", "> los"])], "doc_id string, line_no int, line string")
    assert rows(D.markdown_records(md)) == [("m", "A", 30.5, "een twee"), ("m", "B", None, None)]
    assert D.header_labels(["a", "b", None], ["", "c", None]) == ["a", "c", "column_2"]
    reply = spark.range(1).select(D.parse_reply(F.lit('```json\n{"x": 8}\n```'), "x int").x.alias("x"), D.parse_reply(F.lit("nee"), "x int").x.alias("y")).first()
    assert (reply.x, reply.y) == (8, None)
    assert rows(D.labelled_numbers(spark.createDataFrame([("d", "Shell plc 1.234\n\nASML 5")], "doc_id string, text string")).select("label", "value")) == [("ASML", 5), ("Shell plc", 1234)]


def test_pdf_check(spark):
    df = spark.createDataFrame([(bytearray(b"%PDF-1.7"), 60000, None), (bytearray(b"<html>"), 60000, None), (bytearray(b"%PDF-"), 10, None), (bytearray(b"%PDF-"), 60000, "text/html")], "c binary, n long, t string")
    assert [r.ok for r in df.select(D.is_pdf(F.col("c"), F.col("n"), content_type=F.col("t")).alias("ok")).collect()] == [True, False, False, False]


PAGE = "<html><script>var x='<a href=q>';</script><a href='/a.pdf' title='T'> </a><a href='b'>tekst</a><a href='c'><img alt='plaatje'></a><table><tr><th>N</th><th>V</th></tr><tr><td>x</td><td>1,5%</td></tr></table><p>indexatie 2,5% per jaar</p><!-- weg --></html>"


def test_html(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, "")], "page_id long, html string")
    assert [(r.href, r.label) for r in html.links(pages).orderBy("pos").collect()] == [("/a.pdf", "T"), ("b", "tekst"), ("c", "plaatje")]
    assert [r.cells for r in html.rows(pages, 2).orderBy("row_no").collect()] == [["N", "V"], ["x", "1,5%"]]
    assert html.blocks(pages, "p").first().block == "indexatie 2,5% per jaar"
    assert [r.block for r in html.snippets(pages, "indexatie").collect()] == ["indexatie 2,5% per jaar"]
    text = pages.where("page_id = 1").select(html.visible_text(F.col("html")).alias("t")).first().t
    assert text == "tekst N V x 1,5% indexatie 2,5% per jaar"


def test_discovery(spark, tmp_path):
    where = f"file://{tmp_path}/found"
    schema = "url string, title string"
    discovery.append_new(spark, spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1")], schema), where)
    assert rows(spark.read.parquet(where)) == [("a", "1"), ("b", "1")]
    spark.createDataFrame([("b", "x"), ("c", "x")], schema).write.json(f"{tmp_path}/in")
    discovery.watch(spark.readStream.schema(schema).json(f"{tmp_path}/in"), where, f"{tmp_path}/cp").awaitTermination(60)
    assert sorted(r.url for r in spark.read.parquet(where).collect()) == ["a", "b", "c"]


def test_stage_runner(spark):
    texts = spark.createDataFrame([(1, "De aandelen worden passief beheerd: Europa 60% en Azië 40%.")], "fund_id long, text string")
    out = pipeline.run(spark, {"report_texts": texts}, [("extract", pipeline.equity_strategy), ("none", None)])
    assert {(r.region, r.weight_pct) for r in out["equity_strategies"].collect()} == {("Europe", 60.0), ("Other", 40.0)}

    def broken(*_):
        raise ValueError("broken")

    with pytest.raises(ValueError, match="broken"):
        pipeline.run(spark, {}, [("bad", broken), ("never", lambda *_: pytest.fail("ran"))])


def test_schemas(spark):
    for name, ddl in schemas.TABLES.items():
        assert spark.createDataFrame([], ddl).columns, name
