"""Sinks and table changes: what is written is read back within the query. Folders lie in the session's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.catalog import Catalog, Timed
from fundlake.operators import curation, merge
from fundlake.operators.keyed import KeyedTable
from fundlake.operators.lineage import folder
from fundlake.plans import export, pipeline
from fundlake.plans.registry import Tables, query
from fundlake.sources import documents as D
from fundlake.sources import workbook
from fundlake.streaming import discovery


#: Folders of each query's last call: what a query returns is read later, so they go when it is called again.
_LEFT: dict[str, list[str]] = {}


def _place(t: Tables, name: str) -> str:
    path = f"{folder(t.spark)}/fundlake-{name}-{uuid.uuid4().hex}"
    _LEFT.setdefault(t.name, []).append(path)
    return path


def _tidy(spark: SparkSession, name: str) -> None:
    """Delete what the last call of a query left."""
    for path in _LEFT.pop(name, ()):
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _rows(t: Tables) -> DataFrame:
    return t.supplier.select(F.col("s_suppkey").cast("long").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("aum_euro_bn"))


@query("SELECT s_suppkey AS id, s_name AS name, s_acctbal AS aum_euro_bn, true AS none_before FROM supplier", before=_tidy)
def q_catalog_insert(t: Tables) -> DataFrame:
    """SRC-01, SRC-03, SRC-04, SNK-01, SNK-04: tables created once, rows added, read by a query; columns by name."""
    c = Catalog(t.spark, _place(t, "catalog"))
    c.create()
    c.create()  # a second time changes nothing
    before = c.table("funds").limit(1).count()
    rows = _rows(t)
    c.append("funds", rows.select(*[F.col(x) if x in rows.columns else F.lit(None).alias(x) for x in c.table("funds").columns]))
    c.views()
    found = c.sql("SELECT id, name, aum_euro_bn FROM funds WHERE id >= :low", {"low": 0}).withColumn("none_before", F.lit(before == 0))
    c.drop_views()
    return found


@query("SELECT s_suppkey AS id, 'neu ' || s_name AS name FROM supplier WHERE s_suppkey % 2 = 0", before=_tidy)
def q_catalog_replace(t: Tables) -> DataFrame:
    """SNK-16, SNK-30: a table deleted and filled again at once, from its own old rows."""
    c = Catalog(t.spark, _place(t, "catalog"))
    c.create()
    rows = _rows(t)
    c.append("funds", rows.select(*[F.col(x) if x in rows.columns else F.lit(None).alias(x) for x in c.table("funds").columns]))
    c.replace("funds", c.table("funds").where("id % 2 = 0").withColumn("name", F.concat(F.lit("neu "), "name")))
    c.drop_views()
    return c.table("funds").select("id", "name")


@query("SELECT s_suppkey AS id, NULL::DOUBLE AS ratio, 0 AS done, s_name AS name FROM supplier")
def q_add_columns(t: Tables) -> DataFrame:
    """SNK-02, SNK-03: columns are added once; one that is there is reset."""
    rows = merge.add_columns(_rows(t).drop("aum_euro_bn"), ratio="double", name="string")
    again = merge.add_columns(rows, ratio="double")
    return merge.set_column(merge.set_column(again, "done", 1), "done", 0)


_CSV = "id long, name string, aum double"


@query("SELECT s_suppkey AS id, s_name AS name, s_acctbal AS aum FROM supplier UNION ALL SELECT -1, 'Extra', 2.5", before=_tidy)
def q_csv_append(t: Tables) -> DataFrame:
    """SNK-19, SNK-21, SRC-05, SRC-23: a fresh CSV file, rows appended, read with a declared schema."""
    path = _place(t, "csv")
    export.write_csv(_rows(t).toDF("id", "name", "aum"), path)
    export.write_csv(t.spark.createDataFrame([(-1, "Extra", 2.5)], _CSV), path, "append")
    return D.csv(t.spark, path, _CSV)


@query("SELECT s_suppkey AS id, s_name AS name, CASE WHEN s_suppkey % 3 = 0 THEN 1.0 ELSE s_acctbal END AS aum FROM supplier UNION ALL SELECT 1000000, NULL, 1.0", before=_tidy)
def q_csv_upsert(t: Tables) -> DataFrame:
    """SNK-20: read, change by key, write anew; a missing key is appended."""
    old, new = _place(t, "csv"), _place(t, "csv")
    export.write_csv(_rows(t).toDF("id", "name", "aum"), old)
    change = t.supplier.where("s_suppkey % 3 = 0").select(F.col("s_suppkey").cast("long").alias("id"), F.lit(1.0).alias("aum")).union(t.spark.createDataFrame([(1000000, 1.0)], "id long, aum double"))
    export.write_csv(merge.upsert(D.csv(t.spark, old, _CSV), change, ["id"], ["aum"]), new)
    return D.csv(t.spark, new, _CSV)


@query("SELECT s_name AS fund_name, n_name AS manager, n_nationkey AS nr FROM nation JOIN supplier ON n_nationkey = s_nationkey", before=_tidy)
def q_sheets(t: Tables) -> DataFrame:
    """SNK-22, SNK-27, PRJ-04, PRJ-09: a sheet for each table, the fund's name first, its id gone; written as a folder of CSV files and read back."""
    funds = _rows(t).withColumns({"category": F.lit("APF")})
    managers = t.nation.join(t.supplier, F.col("n_nationkey") == F.col("s_nationkey")).select(F.col("s_suppkey").cast("long").alias("fund_id"), F.col("n_name").alias("manager"), F.col("n_nationkey").alias("nr"))
    root = _place(t, "sheets")
    for name, df in export.sheets({"funds": funds, "managers": managers}).items():
        export.write_csv(df, f"{root}/{name}")
    return D.csv(t.spark, f"{root}/managers", "fund_name string, manager string, nr long")


@query("SELECT 'id,name,category,aum' AS layout, count(*) AS n FROM supplier")
def q_column_order(t: Tables) -> DataFrame:
    """PRJ-05, PRJ-04, PRJ-09: a column moved behind another, renamed, a helper dropped after the sort."""
    df = _rows(t).withColumn("category", F.lit("x")).withColumn("len", F.length("name")).orderBy("len", "name").drop("len")
    df = export.move_after(df.withColumnRenamed("aum_euro_bn", "aum"), "category", "name")
    return df.agg(F.lit(",".join(df.columns)).alias("layout"), F.count("*").alias("n"))


@query("""SELECT 0::BIGINT AS n, '|---|---|' AS line UNION ALL SELECT -1, '| r_name | r_regionkey |' UNION ALL SELECT row_number() OVER (ORDER BY r_name), '| ' || r_name || ' | ' || r_regionkey || ' |' FROM region""")
def q_markdown_report(t: Tables) -> DataFrame:
    """SNK-24, SRT-01, STR-16: the lines of a table in a report."""
    return export.markdown_table(t.region.withColumn("r_name", F.concat("r_name", F.lit("|"))), ["r_name", "r_regionkey"], ["r_name"])


@query("SELECT c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN '-' ELSE c_mktsegment END AS category FROM customer WHERE c_custkey % 3 = 0 OR c_mktsegment <> 'MACHINERY'")
def q_word_rows(t: Tables) -> DataFrame:
    """SNK-25: rows of a document's table, insurers left out, a dash for null."""
    category = F.when(F.col("c_custkey") % 3 == 0, None).when(F.col("c_mktsegment") == "MACHINERY", "Pension Insurers").otherwise(F.col("c_mktsegment"))
    return export.word_rows(t.customer.select(F.col("c_name").alias("name"), category.alias("category")), ["name", "category"])


@query("SELECT n_name AS fund, r_name AS region, (n_nationkey * 1.5)::DOUBLE AS weight_pct, row_number() OVER (ORDER BY n_nationkey DESC, r_name)::INTEGER AS place FROM nation JOIN region ON n_regionkey = r_regionkey")
def q_stacked_bars(t: Tables) -> DataFrame:
    """SNK-26, SRT-08, SRT-10, SRT-11: rows in the order of another frame, as a chart stacks them."""
    from pyspark.sql import Window

    weights = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("fund"), F.col("r_name").alias("region"), (F.col("n_nationkey") * 1.5).cast("double").alias("weight_pct"))
    order = t.nation.select(F.col("n_name").alias("fund"), (-F.col("n_nationkey")).alias("ord"))
    # One row a nation: a chart's rows, not the data's.
    place = F.row_number().over(Window.orderBy("ord", "region"))
    return export.stacked_bars(weights, order, "fund").join(order, "fund").withColumn("place", place).drop("ord")


@query("SELECT name, least(coalesce(max(n), 0) + 2, 50)::INTEGER AS width FROM (SELECT 'c_name' AS name, length(c_name) AS n FROM customer UNION ALL SELECT 'c_mktsegment', length(c_mktsegment) FROM customer) GROUP BY 1")
def q_sheet_widths(t: Tables) -> DataFrame:
    """SNK-27, AGG-24: widths of a sheet's columns, with margin and bound."""
    one = export.widths(t.customer.select("c_name", "c_mktsegment"))
    return one.unpivot([], ["c_name", "c_mktsegment"], "name", "width")


@query("SELECT 'funds' AS name, count(*) AS n FROM supplier UNION ALL SELECT 'large', count(*) FROM supplier WHERE s_acctbal > 5000")
def q_stages(t: Tables) -> DataFrame:
    """ORC-01, ORC-02, SNK-28, AGG-25: stages in order, logged and timed; one that is missing is skipped."""
    stages = [
        ("load", lambda spark, tables: {"funds": _rows(t)}),
        ("absent", None),
        ("select", lambda spark, tables: {"large": tables["funds"].where("aum_euro_bn > 5000")}),
    ]
    out = pipeline.run(t.spark, {}, stages)
    return out["funds"].agg(F.lit("funds").alias("name"), F.count("*").alias("n")).union(out["large"].agg(F.lit("large"), F.count("*")))


_COUNTED = """t AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS v FROM customer WHERE c_custkey % 5 <> 0), s AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 7 = 0 THEN c_acctbal ELSE c_acctbal + 1 END AS v FROM customer WHERE c_custkey % 2 = 0),
j AS (SELECT coalesce(t.k, s.k) AS k, t.k IS NULL AS fresh, s.k IS NOT NULL AS hit, t.v AS a, s.v AS b FROM t FULL JOIN s ON t.k = s.k)"""


@query(f"""WITH {_COUNTED}, c AS (SELECT CASE WHEN fresh THEN 'inserted' WHEN NOT hit OR a IS NOT DISTINCT FROM b THEN 'kept' WHEN a IS NULL THEN 'filled' ELSE 'updated' END AS change FROM j)
SELECT 'merge.values' AS stage, x.change, count(c.change) AS n FROM (VALUES ('inserted'), ('updated'), ('filled'), ('kept')) x(change) LEFT JOIN c USING (change) GROUP BY ALL
UNION ALL SELECT 'merge.values', 'rows', count(*) FROM j UNION ALL SELECT 'load.target', 'rows', count(*) FROM t UNION ALL SELECT 'load.source', 'rows', count(*) FROM s""", before=_tidy)
def q_counts_in_flight(t: Tables) -> DataFrame:
    """SNK-05, SNK-13, AGG-25, SNK-28: what each stage's write did, counted while its rows passed."""
    k, v = F.col("c_custkey"), F.col("c_acctbal")
    target = t.customer.where("c_custkey % 5 <> 0").select(k.alias("k"), F.when(k % 3 != 0, v).alias("v"))
    source = t.customer.where("c_custkey % 2 = 0").select(k.alias("k"), F.when(k % 7 == 0, v).otherwise(v + 1).alias("v"))
    stages = [("load", lambda spark, tables: {"target": target, "source": source}), ("merge", lambda spark, tables: {"values": merge.tracked(tables["target"], tables["source"], ["k"], ["v"], "upsert")})]
    counts: dict[str, dict[str, int]] = {}
    pipeline.run(t.spark, {}, stages, _place(t, "stages"), counts)
    rows = [(stage, change, n) for stage, found in counts.items() for change, n in found.items()]
    return t.spark.createDataFrame(rows, "stage string, change string, n long")


@query(f"WITH {_COUNTED} SELECT k, CASE WHEN hit THEN b ELSE a END AS v FROM j", before=_tidy)
def q_tracked_upsert(t: Tables) -> DataFrame:
    """SNK-07, SNK-08: the same change as it is stored."""
    k, v = F.col("c_custkey"), F.col("c_acctbal")
    target = t.customer.where("c_custkey % 5 <> 0").select(k.alias("k"), F.when(k % 3 != 0, v).alias("v"))
    source = t.customer.where("c_custkey % 2 = 0").select(k.alias("k"), F.when(k % 7 == 0, v).otherwise(v + 1).alias("v"))
    return pipeline.store(merge.tracked(target, source, ["k"], ["v"], "upsert"), _place(t, "upsert"))[0]


@query(f"WITH {_COUNTED}, n AS (SELECT k, CASE WHEN hit THEN b ELSE a END AS v FROM j) SELECT k, CASE WHEN k % 11 = 0 THEN coalesce(v, -1.0) ELSE v END AS v FROM n", before=_tidy)
def q_keyed_changes(t: Tables) -> DataFrame:
    """SNK-07, SNK-08, SNK-13: an upsert and a fill of a table kept by key, part by part."""
    k, v = F.col("c_custkey"), F.col("c_acctbal")
    table = KeyedTable(t.spark, _place(t, "keyed"), "k long, v double", ["k"], 8)
    table.replace(t.customer.where("c_custkey % 5 <> 0").select(k.alias("k"), F.when(k % 3 != 0, v).alias("v")))
    table.upsert(t.customer.where("c_custkey % 2 = 0").select(k.alias("k"), F.when(k % 7 == 0, v).otherwise(v + 1).alias("v")), ["v"])
    table.update(t.customer.where("c_custkey % 11 = 0").select(k.alias("k"), F.lit(-1.0).alias("v")), ["v"], "fill")
    out = table.frame()
    table.close()
    return out


@query("SELECT 'supplier' AS sheet, s_suppkey AS id, s_name AS name, s_acctbal AS amount FROM supplier UNION ALL SELECT 'nation', n_nationkey, n_name, NULL FROM nation", before=_tidy)
def q_workbooks(t: Tables) -> DataFrame:
    """SNK-22, SRC-06: tables as workbooks, written in parallel and read by file and sheet."""
    workbook.register(t.spark)
    root = _place(t, "books")
    frames = {"supplier": t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("amount")), "nation": t.nation.select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"), F.lit(None).cast("double").alias("amount"))}
    out = []
    for name, df in frames.items():
        df.write.format("workbook").option("sheet", name).mode("append").save(f"{root}/{name}")
        out.append(t.spark.read.format("workbook").schema("id long, name string, amount double").option("sheet", name).load(f"{root}/{name}").select(F.lit(name).alias("sheet"), "id", "name", "amount"))
    return out[0].union(out[1])


@query("SELECT DISTINCT user_id, event_type FROM events", before=_tidy)
def q_stream_discovery(t: Tables) -> DataFrame:
    """STM-01: a stream of events to those of new keys; started again, it adds nothing. (A source of files takes a folder or a pattern.)"""
    path, keep = _place(t, "found"), _place(t, "progress")
    key = F.concat_ws("/", F.col("user_id").cast("string"), "event_type")
    for _ in range(2):
        source = t.spark.readStream.schema(t.events.schema).parquet(f"{t.path}/event[s].parquet").select(key.alias("url"), "user_id", "event_type")
        run = discovery.watch_keyed(source, path, keep)
        run.awaitTermination()
    return t.spark.read.parquet(path).select("user_id", "event_type")


@query("""WITH RECURSIVE links AS (SELECT '/p/' || p_partkey AS page, unnest(['/p/' || (p_partkey + 1), '/bestuur/' || p_partkey]) AS url FROM part),
steps AS (SELECT s_suppkey AS site, '/p/' || s_suppkey AS url, 0 AS step FROM supplier UNION ALL SELECT site, links.url, step + 1 FROM steps JOIN links ON page = steps.url WHERE step < 4),
ranked AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY step, contains(url, 'bestuur') DESC, url) AS n FROM steps)
SELECT site, url, step FROM ranked WHERE n <= 6""")
def q_crawl(t: Tables) -> DataFrame:
    """STM-03: a walk from every supplier's page over links between the pages of parts, priority words first, ended by the budget of pages alone."""
    k = F.col("p_partkey")
    page = lambda kind, key: F.concat(F.lit(f"/{kind}/"), key.cast("string"))
    links = t.part.select(page("p", k).alias("page"), F.explode(F.array(page("p", k + 1), page("bestuur", k))).alias("url"))
    start = t.supplier.select(F.col("s_suppkey").alias("site"), page("p", F.col("s_suppkey")).alias("url"))
    return curation.walk_links(links, start, 6, priority=("bestuur",)).select("site", "url", "step")


@query("SELECT s_suppkey AS id, CASE WHEN s_suppkey % 4 = 0 THEN s_suppkey % 8 = 0 END AS ok FROM supplier")
def q_pdf_bytes(t: Tables) -> DataFrame:
    """SNK-23: bytes kept only if they are a report: mark, length, not a web page."""
    k = F.col("s_suppkey")
    content = F.when(k % 4 == 0, F.when(k % 8 == 0, F.lit(b"%PDF-1.7 x")).otherwise(F.lit(b"<html>")))
    return t.supplier.select(k.alias("id"), D.is_pdf(content, F.lit(60 * 1024), content_type=F.lit("application/pdf")).alias("ok"))


@query("SELECT user_id, event_type FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS r FROM events) WHERE r = 1")
def q_seen_once(t: Tables) -> DataFrame:
    """SET-05: each key once a run."""
    return t.events.select("user_id", "event_type").dropDuplicates()


@query("SELECT count(*) AS n, 1 AS made_in_time, 2 AS made_after FROM supplier")
def q_timed_cache(t: Tables) -> DataFrame:
    """STM-02: a result is made once within its time, and again after it."""
    now, made = [0.0], []

    def make() -> DataFrame:
        made.append(now[0])
        return t.supplier.agg(F.count("*").alias("n"))

    held = Timed(3600, lambda: now[0])
    held.get("n", make)
    now[0] = 3599.0
    held.get("n", make)
    in_time = len(made)
    now[0] = 3601.0
    out = held.get("n", make).select("n", F.lit(in_time).alias("made_in_time"), F.lit(len(made)).alias("made_after"))
    held.clear()
    return out
