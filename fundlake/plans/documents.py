"""Queries on document text: pages, windows, layout, tables, files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.operators import curation, tables
from fundlake.plans.registry import Tables, query
from fundlake.sources import documents as D
from fundlake.sources import html

_SPLIT = "string_split(text, chr(10))"
_PAGES = f"pages AS (SELECT doc_id, unnest({_SPLIT}) AS text, generate_subscripts({_SPLIT}, 1) - 1 AS page_no FROM documents)"


def _pages(t: Tables) -> DataFrame:
    """Every line of a document as a page of its own."""
    return t.documents.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("page_no", "text"))


@query(f"SELECT doc_id, md5(replace(text, chr(10), '')) AS whole, md5(array_to_string(list_slice({_SPLIT}, 1, 3), ' ')) AS head, md5(lower(replace(text, chr(10), ' '))) AS low FROM documents WHERE text IS NOT NULL")
def q_whole_text(t: Tables) -> DataFrame:
    """SRC-08, SRC-09, SRC-10: all pages, the first ones, all in lower case."""
    p = _pages(t)
    parts = [D.whole_text(p).withColumnRenamed("text", "whole"), D.whole_text(p, " ", 3).withColumnRenamed("text", "head"), D.whole_text(p, " ", lower=True).withColumnRenamed("text", "low")]
    joined = parts[0].join(parts[1], "doc_id").join(parts[2], "doc_id")
    return joined.select("doc_id", *[F.md5(c).alias(c) for c in ("whole", "head", "low")])


@query(f"WITH {_PAGES} SELECT doc_id, page_no::INTEGER AS page_no, md5(text) AS digest FROM pages WHERE regexp_matches(lower(text), 'the |und |que ')")
def q_focus_pages(t: Tables) -> DataFrame:
    """SRC-11, EX-44: pages that hold a word."""
    return D.focus_pages(_pages(t), ("the ", "und ", "que ")).select("doc_id", "page_no", F.md5("text").alias("digest"))


@query(f"WITH {_PAGES} SELECT doc_id, page_no::INTEGER AS page_no, md5(substr(text, 1, 40)) AS digest FROM pages WHERE page_no BETWEEN 1 AND 3")
def q_page_window(t: Tables) -> DataFrame:
    """SRC-15: some pages, their first characters."""
    return D.page_window(_pages(t), 1, 3, 40).select("doc_id", "page_no", F.md5("text").alias("digest"))


@query(f"""WITH {_PAGES}, r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page_no DESC) AS r FROM pages),
m AS (SELECT doc_id, page_no, '--- PAGE ' || page_no || ' ---' || chr(10) || text AS text FROM r WHERE r <= 50 AND regexp_matches(lower(text), 'the |und |que ')),
b AS (SELECT *, coalesce(sum(length(text)) OVER (PARTITION BY doc_id ORDER BY page_no DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM m)
SELECT doc_id, md5(string_agg(text, chr(10) ORDER BY page_no)) AS digest FROM b WHERE before <= 1500 GROUP BY doc_id""")
def q_last_pages(t: Tables) -> DataFrame:
    """SRC-12, WIN-13: from the back until the budget of characters is exceeded."""
    return D.last_pages(_pages(t), ("the ", "und ", "que "), 50, 1500).select("doc_id", F.md5("text").alias("digest"))


def _around(before: int, after: int) -> str:
    return f"md5(string_agg(text, ' ') OVER (PARTITION BY doc_id ORDER BY page_no ROWS BETWEEN {before} PRECEDING AND {after} FOLLOWING))"


_WINDOWS = {"w4_4": (4, 4), "w0_2": (0, 2), "w2_2": (2, 2), "w1_1": (1, 1), "w2_1": (2, 1), "w3_7": (3, 7), "w5_9": (5, 9), "w0_4": (0, 4)}


@query(f"WITH {_PAGES} SELECT doc_id, page_no::INTEGER AS page_no, {', '.join(f'{_around(*w)} AS {name}' for name, w in _WINDOWS.items())} FROM pages")
def q_line_windows(t: Tables) -> DataFrame:
    """WIN-02, WIN-03, WIN-04, WIN-05, WIN-06, WIN-07: lines with those before and after; all windows share one sort."""
    rows = _pages(t)
    for name, (before, after) in _WINDOWS.items():
        rows = D.context(rows, ["doc_id"], "page_no", "text", before, after).withColumnRenamed("context", name)
    return rows.select("doc_id", "page_no", *[F.md5(c).alias(c) for c in _WINDOWS])


_SPANS = "SELECT l_orderkey AS doc_id, 0 AS page_no, (l_linenumber * 31 % 7)::DOUBLE AS x, (l_linenumber * 13 % 4) * 5 + 1.0 AS y, ' ' || l_linenumber || ' ' AS text FROM lineitem"


@query(f"SELECT doc_id, page_no, (round_even(y / 5, 0) * 5)::DOUBLE AS y, string_agg(trim(text), ' ' ORDER BY x, trim(text)) AS line FROM ({_SPANS}) GROUP BY ALL")
def q_layout_rows(t: Tables) -> DataFrame:
    """SRC-13, AGG-23, SRT-09: spans gathered into rows by rounded height, from left to right."""
    spans = t.lineitem.selectExpr("l_orderkey AS doc_id", "0 AS page_no", "CAST(l_linenumber * 31 % 7 AS DOUBLE) AS x", "CAST((l_linenumber * 13 % 4) * 5 + 1 AS DOUBLE) AS y", "concat(' ', l_linenumber, ' ') AS text")
    return D.layout_rows(spans).select("doc_id", "page_no", "y", F.array_join(F.transform("items", lambda i: i.text), " ").alias("line"))


_PLACED = """SELECT l_orderkey AS doc_id, 0 AS page_no, s.x AS x, l_linenumber * 12 + CASE WHEN l_linenumber > 3 THEN 60 ELSE 0 END + s.dy AS y, s.t AS text, s.r AS rgt FROM (
  SELECT *, unnest([{'x': 10.0::DOUBLE, 'dy': 0.0::DOUBLE, 't': l_returnflag || ' regel ' || l_linenumber, 'r': 10.0::DOUBLE + 5 * length(l_returnflag || ' regel ' || l_linenumber)},
    {'x': 200.0::DOUBLE - 5 * length(q), 'dy': 1.5::DOUBLE, 't': q, 'r': 200.0::DOUBLE}, {'x': 300.0::DOUBLE - 5 * length(p), 'dy': -1.5::DOUBLE, 't': p, 'r': 300.0::DOUBLE},
    {'x': 10.0::DOUBLE, 'dy': -11.0::DOUBLE, 't': CASE WHEN l_linenumber IN (1, 4) THEN 'Een kop over alle kolommen van de tabel' END, 'r': NULL::DOUBLE}]) AS s
  FROM (SELECT *, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS q, CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) AS p FROM lineitem)) WHERE s.t IS NOT NULL"""
_CELLS = f"""WITH a AS (SELECT doc_id, page_no, x, y, trim(text) AS text, coalesce(rgt, x + 5 * length(text)) AS rgt FROM ({_PLACED})),
b AS (SELECT *, coalesce(y - lag(y) OVER (PARTITION BY doc_id, page_no ORDER BY y, x, text), 'Infinity'::DOUBLE) AS d FROM a),
c AS (SELECT *, count(*) FILTER (WHERE d > 4) OVER o AS row_no, count(*) FILTER (WHERE d > 25) OVER o AS block FROM b WINDOW o AS (PARTITION BY doc_id, page_no ORDER BY y, x, text)),
e AS (SELECT *, count(*) OVER (PARTITION BY doc_id, page_no, row_no) AS n FROM c),
f AS (SELECT *, max(CASE WHEN n > 1 THEN rgt END) OVER (PARTITION BY doc_id, page_no, block ORDER BY x, rgt, y, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM e),
g AS (SELECT *, greatest(count(*) FILTER (WHERE n > 1 AND coalesce(x > reach + 8, true)) OVER (PARTITION BY doc_id, page_no, block ORDER BY x, rgt, y, text) - 1, 0) AS col_no FROM f),
h AS (SELECT doc_id, page_no, block, row_no, col_no, string_agg(text, ' ' ORDER BY x, y, text) AS text FROM g GROUP BY ALL)"""


def _placed(t: Tables) -> DataFrame:
    """Lines of orders as they stand on a page: a label, two numbers set to the right, each a little off in height; headings; two tables from the fourth line on."""
    k, text = F.col("l_linenumber"), lambda c: c.cast("long").cast("string")
    label = F.concat("l_returnflag", F.lit(" regel "), k.cast("string"))
    place = lambda x, dy, value, right: F.struct(x.alias("x"), F.lit(dy).alias("dy"), value.alias("text"), right.alias("right"))
    left = lambda edge, value: F.lit(edge) - 5 * F.length(value)
    q, p = text(F.col("l_quantity")), text(F.floor("l_extendedprice"))
    spans = F.array(place(F.lit(10.0), 0.0, label, F.lit(10.0) + 5 * F.length(label)), place(left(200.0, q), 1.5, q, F.lit(200.0)), place(left(300.0, p), -1.5, p, F.lit(300.0)), place(F.lit(10.0), -11.0, F.when(k.isin(1, 4), "Een kop over alle kolommen van de tabel"), F.lit(None).cast("double")))
    height = k * 12 + F.when(k > 3, 60).otherwise(0)
    rows = t.lineitem.select(F.col("l_orderkey").alias("doc_id"), F.lit(0).alias("page_no"), height.alias("h"), F.explode(spans).alias("s")).where("s.text IS NOT NULL")
    return rows.select("doc_id", "page_no", "s.x", (F.col("h") + F.col("s.dy")).alias("y"), "s.text", "s.right")


@query(f"""{_CELLS},
w AS (SELECT doc_id, page_no, block, max(col_no) AS last, count(DISTINCT row_no) AS n_rows FROM h GROUP BY ALL HAVING max(col_no) > 0 AND count(DISTINCT row_no) > 1),
m AS (SELECT doc_id, page_no, block, row_no, last, r.c AS col_no FROM (SELECT DISTINCT doc_id, page_no, block, row_no FROM h) JOIN w USING (doc_id, page_no, block), range(0, 10) r(c) WHERE r.c <= last),
x AS (SELECT doc_id, page_no, block, row_no, string_agg(coalesce(text, ''), '|' ORDER BY m.col_no) AS line FROM m LEFT JOIN h USING (doc_id, page_no, block, row_no, col_no) GROUP BY ALL)
SELECT doc_id, page_no, (row_number() OVER (PARTITION BY doc_id, page_no ORDER BY block) - 1)::INTEGER AS table_no, lines FROM (SELECT doc_id, page_no, block, string_agg(line, chr(10) ORDER BY row_no) AS lines FROM x GROUP BY ALL)""")
def q_layout_tables(t: Tables) -> DataFrame:
    """SRC-14: tables out of spans, by gaps in their projections on both axes."""
    found = tables.tables(_placed(t))
    return found.select("doc_id", "page_no", "table_no", F.array_join(F.transform("rows", lambda r: F.array_join(r, "|")), "\n").alias("lines"))


@query("""SELECT p_partkey AS doc_id, (p_partkey % 900 + 1 + 0.25)::DOUBLE AS fee FROM part WHERE p_partkey % 2 = 0""")
def q_layout_fees(t: Tables) -> DataFrame:
    """SRC-14, EX-29: from spans of the pages that name the fee to its last number."""
    k, row = F.col("p_partkey"), lambda y, *texts: [F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), (F.lit(c) if isinstance(c, str) else c).alias("text")) for x, c in zip((10.0, 200.0, 320.0), texts, strict=False)]
    kind = F.when(k % 2 == 0, "Performance fee").otherwise("Beheerkosten")
    spans = F.array(*row(5.0, "Jaarverslag, toelichting op de kosten"), *row(50.0, "Kosten", "2022", "2023"), *row(62.0, "Overig", "12,5", "13"), *row(74.0, kind, "7,5", F.concat((k % 900 + 1).cast("string"), F.lit(",25"))), *row(86.0, "Totaal", "1", "2"))
    pages = t.part.select(k.alias("doc_id"), F.lit(3).alias("page_no"), F.explode(spans).alias("s")).select("doc_id", "page_no", "s.*")
    return curation.table_fees(tables.tables(tables.keyword_pages(pages, ("performance fee", "prestatievergoeding"))))


@query("""SELECT p_partkey AS doc_id, x.n AS name, x.a AS allocation_pct, x.t AS notes FROM (SELECT p_partkey, unnest([
{'n': 'Fonds ' || p_partkey, 'a': (p_partkey % 90 + 0.5)::DOUBLE, 't': 'eerste regel tweede ' || p_partkey}, {'n': 'Leeg', 'a': NULL, 't': NULL}]) AS x FROM part)""")
def q_markdown_records(t: Tables) -> DataFrame:
    """SRC-17: headings open records; fields and quoted notes below."""
    text = F.expr("concat_ws('\n', 'kop', concat('## Fonds ', CAST(p_partkey AS STRING)), concat('- **Equity Allocation:** ', CAST(p_partkey % 90 AS STRING), '.5%'), '> geen notitie', '- **Strategy Notes:**', '> eerste regel', concat('> tweede ', CAST(p_partkey AS STRING)), '## Leeg')")
    return D.markdown_records(D.lines(t.part.select(F.col("p_partkey").alias("doc_id"), text.alias("text"))))


_TABLE = "'<table><tr><th>Naam</th><th>A</th></tr><tr><td>Fonds ' || p_partkey || '</td><td> ' || p_partkey % 90 || ',5% </td><td>x</td><td>y</td></tr></table>'"


@query("SELECT p_partkey, r.n::INTEGER AS row_no, r.c AS cells FROM (SELECT p_partkey, unnest([{'n': 0, 'c': 'Naam|A'}, {'n': 1, 'c': 'Fonds ' || p_partkey || '|' || p_partkey % 90 || ',5%|x|y'}]) AS r FROM part)")
def q_table_rows(t: Tables) -> DataFrame:
    """SRC-18: rows of a page's table, header and body."""
    pages = t.part.select("p_partkey", F.expr(_TABLE).alias("html"))
    return html.rows(pages).select("p_partkey", "row_no", F.array_join("cells", "|").alias("cells"))


@query("SELECT p_partkey, p_partkey % 90 || ',5%' AS cell FROM part")
def q_table_rows_of_four(t: Tables) -> DataFrame:
    """SRC-19: only rows of four cells and more."""
    pages = t.part.select("p_partkey", F.expr(_TABLE).alias("html"))
    return html.rows(pages, 4).select("p_partkey", F.get("cells", 1).alias("cell"))


@query("SELECT p_partkey AS doc_id, x.l AS label, x.v::BIGINT AS value FROM (SELECT p_partkey, unnest([{'l': 'Totaal deelnemers', 'v': p_partkey * 1000 + 7}, {'l': 'Slapers', 'v': p_partkey}]) AS x FROM part)")
def q_labelled_numbers(t: Tables) -> DataFrame:
    """SRC-26, NUM-17: a label and the number that ends its line."""
    text = F.expr("concat('Totaal deelnemers ', CAST(p_partkey AS STRING), '.007\n\nSlapers ', CAST(p_partkey AS STRING))")
    return D.labelled_numbers(t.part.select(F.col("p_partkey").alias("doc_id"), text.alias("text"))).select("doc_id", "label", "value")


@query(f"WITH {_PAGES} SELECT doc_id, page_no::INTEGER AS page_no, md5(chr(10) || text || chr(10)) AS digest FROM pages")
def q_page_dump(t: Tables) -> DataFrame:
    """SRC-32: one text with marks between the pages, split again."""
    marked = _pages(t).select("doc_id", "page_no", F.concat(F.lit("--- PAGE "), F.col("page_no").cast("string"), F.lit(" ---\n"), F.col("text"), F.lit("\n")).alias("text"))
    return D.split_pages(D.whole_text(marked)).select("doc_id", "page_no", F.md5("text").alias("digest"))


@query("SELECT s_suppkey, {'a': CASE WHEN s_suppkey % 3 = 0 THEN 'Totaal' ELSE 'Rendement' END}.a AS label FROM supplier")
def q_header_labels(t: Tables) -> DataFrame:
    """SRC-07, SRC-06: two header rows of a landed sheet become one; columns are taken by place."""
    labels = D.header_labels(["Totaal", "Totaal", None], [None, "Rendement", " "])
    sheet = t.supplier.select("s_suppkey", F.lit(labels[0]).alias("c0"), F.lit(labels[1]).alias("c1"), F.lit(labels[2]).alias("c2"))
    by_place = sheet.columns
    return sheet.select("s_suppkey", F.when(F.col("s_suppkey") % 3 == 0, F.col(by_place[1])).otherwise(F.col(by_place[2])).alias("label"))


@query("SELECT page_id, href, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href AS url FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href=\"(/[^\"]*)\">', 1)) AS href FROM pages) WHERE href NOT LIKE '//%'")
def q_resolved_links(t: Tables) -> DataFrame:
    """URL-01, SRC-22: links as seen from their page."""
    from fundlake.functions.names import resolve

    links = html.links(t.pages.select("page_id", "url", "html")).where(F.col("href").startswith("/") & ~F.col("href").startswith("//"))
    return links.select("page_id", "href", resolve(F.col("url"), F.col("href")).alias("url"))


@query("SELECT s_suppkey AS id, CASE s_suppkey WHEN 1 THEN 'Fonds A' WHEN 2 THEN 'Fonds B' ELSE s_name END AS name FROM supplier UNION ALL SELECT -1, 'Fonds C'")
def q_literal_rows(t: Tables) -> DataFrame:
    """SRC-25: rows written out in the program change those of a table, or join them."""
    from fundlake.operators import merge

    written = t.spark.createDataFrame([(1, "Fonds A"), (2, "Fonds B"), (-1, "Fonds C")], "id long, name string")
    return merge.upsert(t.supplier.select(F.col("s_suppkey").cast("long").alias("id"), F.col("s_name").alias("name")), written, ["id"], ["name"])
