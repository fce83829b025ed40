"""Relational queries: joins, aggregates, ranks, reshaping, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlake.operators import merge, scan
from fundlake.plans.registry import Tables, query
from fundlake.sources import documents as D

REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
_EXPOSURE = """
WITH s AS (
  SELECT p_brand, r_name, sum(l_extendedprice * (1 - l_discount)) AS v
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2),
w AS (SELECT p_brand AS fund, r_name AS region, round(100 * v / sum(v) OVER (PARTITION BY p_brand), 2) AS weight_pct FROM s)
"""


def _weights(t: Tables) -> DataFrame:
    """Shares of revenue by region. Revenue is summed by (part, supplier) keys' attributes only after small tables are joined."""
    place = t.supplier.select("s_suppkey", "s_nationkey").join(F.broadcast(t.nation), F.col("s_nationkey") == F.col("n_nationkey")).join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", "r_name")
    items = t.lineitem.select("l_partkey", "l_suppkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("v"))
    by = items.join(place, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("l_partkey", "r_name").agg(F.sum("v").alias("v"))
    sums = by.join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand", "r_name").agg(F.sum("v").alias("v"))
    total = F.sum("v").over(Window.partitionBy("p_brand"))
    return sums.select(F.col("p_brand").alias("fund"), F.col("r_name").alias("region"), F.round(100 * F.col("v") / total, 2).alias("weight_pct"))


@query(_EXPOSURE + "SELECT * FROM w")
def q_regional_exposure(t: Tables) -> DataFrame:
    """JN-02, AGG-19."""
    return _weights(t)


@query(_EXPOSURE + "SELECT fund, " + ", ".join(f"max(weight_pct) FILTER (WHERE region = '{r}') AS \"{r}\"" for r in REGIONS) + " FROM w GROUP BY fund")
def q_regional_pivot(t: Tables) -> DataFrame:
    """RSH-01."""
    from fundlake.operators.regions import pivot_weights

    return pivot_weights(_weights(t), "fund", REGIONS)


@query("SELECT d.doc_id, lang, source, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def q_funds_left_esg(t: Tables) -> DataFrame:
    """JN-03."""
    return t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left")


@query("SELECT event_id, c_name, event_type, value FROM events JOIN customer ON user_id = c_custkey ORDER BY ts DESC, event_id DESC LIMIT 300")
def q_news_latest(t: Tables) -> DataFrame:
    """JN-04, SRT-03: the rows are cut before the join, as each event has one customer at most and those without are dropped first."""
    return t.events.join(t.customer.select("c_custkey", "c_name"), F.col("user_id") == F.col("c_custkey")).orderBy(F.desc("ts"), F.desc("event_id")).limit(300).select("event_id", "c_name", "event_type", "value")


@query("SELECT o_orderkey, o_custkey FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey WHERE l_orderkey IS NULL")
def q_anti_no_docs(t: Tables) -> DataFrame:
    """JN-08."""
    return t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey", "o_custkey")


@query("SELECT s_suppkey, s_name FROM supplier WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_returnflag = 'R' AND l_quantity > 49)")
def q_anti_distinct_subq(t: Tables) -> DataFrame:
    """JN-09."""
    return t.supplier.join(t.lineitem.where("l_returnflag = 'R' AND l_quantity > 49"), F.col("s_suppkey") == F.col("l_suppkey"), "left_anti").select("s_suppkey", "s_name")


_NOT_IN = "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT nullif(doc_id, {n}) FROM labels WHERE quality = 0 {w})"


@query(_NOT_IN.format(n=-1, w=""))
def q_not_in(t: Tables) -> DataFrame:
    """JN-10: with SQL's rule that a null in the list leaves no row."""
    return t.spark.sql(_NOT_IN.format(n=-1, w="").replace("FROM documents", "FROM {d}").replace("FROM labels", "FROM {l}"), d=t.documents, l=t.labels)


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_discount > 0.05 AND l_returnflag = 'A')")
def q_semi_distinct(t: Tables) -> DataFrame:
    """JN-07, JN-11."""
    return t.orders.join(t.lineitem.where("l_discount > 0.05 AND l_returnflag = 'A'"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey", "o_orderpriority")


@query("SELECT s_name AS manager, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_name ORDER BY n DESC, manager LIMIT 20")
def q_topk_managers(t: Tables) -> DataFrame:
    """AGG-09: counted by key before the names are joined."""
    n = t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("n"))
    return n.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).groupBy(F.col("s_name").alias("manager")).agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "manager").limit(20)


@query("SELECT c_mktsegment AS category, round(coalesce(sum(c_acctbal), 0), 2) AS aum FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY 1")
def q_market_share(t: Tables) -> DataFrame:
    """AGG-07."""
    return t.customer.where("c_mktsegment IS NOT NULL").groupBy(F.col("c_mktsegment").alias("category")).agg(F.round(F.coalesce(F.sum("c_acctbal"), F.lit(0.0)), 2).alias("aum"))


@query("SELECT c_mktsegment AS category, round(avg(c_acctbal), 4) AS mean_pct FROM customer GROUP BY 1")
def q_avg_by_category(t: Tables) -> DataFrame:
    """AGG-08."""
    return t.customer.groupBy(F.col("c_mktsegment").alias("category")).agg(F.round(F.avg("c_acctbal"), 4).alias("mean_pct"))


@query("SELECT count(*) AS n, round(sum(c_acctbal), 2) AS total, round(avg(c_acctbal), 4) AS mean, count(*) FILTER (WHERE c_acctbal < 0) AS below, arg_max(c_name, struct_pack(a := c_acctbal, k := -c_custkey)) AS largest FROM customer")
def q_kpis(t: Tables) -> DataFrame:
    """AGG-01, AGG-02, AGG-04 to AGG-06, in one pass."""
    return t.customer.agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total"), F.round(F.avg("c_acctbal"), 4).alias("mean"), F.count_if(F.col("c_acctbal") < 0).alias("below"), F.max_by("c_name", F.struct("c_acctbal", -F.col("c_custkey"))).alias("largest"))


@query("SELECT o_orderpriority AS value, count(*) AS n FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1")
def q_value_counts(t: Tables) -> DataFrame:
    """AGG-10."""
    return t.orders.where("o_orderpriority IS NOT NULL").groupBy(F.col("o_orderpriority").alias("value")).agg(F.count("*").alias("n"))


@query("SELECT c_nationkey, arg_max(c_name, struct_pack(a := c_acctbal, k := -c_custkey)) AS largest FROM customer GROUP BY 1")
def q_largest(t: Tables) -> DataFrame:
    """AGG-06 by group; of equals the smaller key."""
    return t.customer.groupBy("c_nationkey").agg(F.max_by("c_name", F.struct("c_acctbal", -F.col("c_custkey"))).alias("largest"))


@query("SELECT user_id, arg_max(value, ts) FILTER (WHERE event_type <> 'view' AND value IS NOT NULL) AS last_value, arg_max(event_type, ts) AS last_type FROM events GROUP BY 1")
def q_last_non_null(t: Tables) -> DataFrame:
    """AGG-11: the last value that isn't null, by column."""
    v = F.when(F.col("event_type") != "view", F.col("value"))
    return t.events.groupBy("user_id").agg(F.max_by(v, F.when(v.isNotNull(), F.col("ts"))).alias("last_value"), F.max_by("event_type", "ts").alias("last_type"))


@query("SELECT floor(o_totalprice / 25000)::BIGINT AS bin, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2")
def q_histogram(t: Tables) -> DataFrame:
    """AGG-12: bins of fixed width."""
    return t.orders.groupBy(F.floor(F.col("o_totalprice") / 25000).alias("bin"), "o_orderstatus").agg(F.count("*").alias("n"))


@query("""WITH j AS (SELECT d.doc_id, quality, nullif(toxic, 0) AS toxic, nullif(lang, 'en') AS lang FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT c AS "column", n AS filled, total - n AS missing, round(100.0 * n / total, 2) AS pct FROM (
  SELECT 'quality' AS c, count(quality) AS n, count(*) AS total FROM j UNION ALL SELECT 'toxic', count(toxic), count(*) FROM j UNION ALL SELECT 'lang', count(lang), count(*) FROM j)""")
def q_completeness(t: Tables) -> DataFrame:
    """AGG-03: all columns in one pass, then turned into rows."""
    j = t.documents.select("doc_id", F.nullif("lang", F.lit("en")).alias("lang")).join(t.labels.select("doc_id", "quality", F.nullif("toxic", F.lit(0)).alias("toxic")), "doc_id", "left")
    return completeness(j, ["quality", "toxic", "lang"])


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    one = df.agg(F.count("*").alias("total"), *[F.count(c).alias(c) for c in columns])
    long = one.unpivot("total", columns, "column", "filled")
    return long.select("column", "filled", (F.col("total") - F.col("filled")).alias("missing"), F.round(F.try_divide(100.0 * F.col("filled"), F.col("total")), 2).alias("pct"))


@query("""SELECT * FROM (SELECT c_custkey, c_acctbal, 'top' AS side FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10)
UNION ALL SELECT * FROM (SELECT c_custkey, c_acctbal, 'bottom' AS side FROM customer ORDER BY c_acctbal, c_custkey LIMIT 10)""")
def q_top_bottom_10(t: Tables) -> DataFrame:
    """SRT-06: two bounded heaps, no full sort."""
    c = t.customer.select("c_custkey", "c_acctbal")
    top = c.orderBy(F.desc("c_acctbal"), "c_custkey").limit(10).withColumn("side", F.lit("top"))
    return top.union(c.orderBy("c_acctbal", "c_custkey").limit(10).withColumn("side", F.lit("bottom")))


@query("""WITH y AS (SELECT c_custkey, list_sort(list_distinct(list(year(o_orderdate)) FILTER (WHERE year(o_orderdate) BETWEEN 1995 AND 2001))) AS ys FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1),
m AS (SELECT c_custkey, list_filter(range(1995, 2002), lambda x: NOT list_contains(coalesce(ys, []), x)) AS ms FROM y)
SELECT c_custkey, len(ms)::INTEGER AS n_missing, array_to_string(ms, ', ') AS missing FROM m WHERE len(ms) > 0""")
def q_year_gap(t: Tables) -> DataFrame:
    """SET-01, AGG-28, DQ-02: the years of a calendar that a fund has no report of."""
    return year_gaps(t.customer.select("c_custkey"), t.orders.select(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year")), "c_custkey", 1995, 2001)


def year_gaps(funds: DataFrame, reports: DataFrame, key: str, first: int, last: int) -> DataFrame:
    found = reports.where(F.col("year").between(first, last)).groupBy(key).agg(F.collect_set("year").alias("found"))
    gaps = F.array_except(F.sequence(F.lit(first), F.lit(last)), F.coalesce("found", F.array().cast("array<int>")))
    return funds.join(found, key, "left").select(key, F.size(gaps).alias("n_missing"), F.array_join(gaps.cast("array<string>"), ", ").alias("missing")).where("n_missing > 0")


@query("SELECT user_id, event_id, rn FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC)::INTEGER AS rn FROM events) WHERE rn <= 10")
def q_latest_n_per_key(t: Tables) -> DataFrame:
    """WIN-11."""
    w = Window.partitionBy("user_id").orderBy(F.desc("ts"))
    return t.events.select("user_id", "event_id", F.row_number().over(w).alias("rn")).where("rn <= 10")


_LINES = "lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n FROM documents)"


@query(f"WITH {_LINES} SELECT doc_id, n::INTEGER AS line_no, md5(string_agg(line, ' ') OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)) AS digest FROM lines")
def q_line_context(t: Tables) -> DataFrame:
    """WIN-01."""
    found = D.context(D.lines(t.documents.select("doc_id", "text")), ["doc_id"], "line_no", "line", 5, 5)
    return found.select("doc_id", "line_no", F.md5("context").alias("digest"))


@query("""WITH s AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '([.!?]) +', '\\1' || chr(1), 'g'), chr(1))) AS s,
  generate_subscripts(string_split(regexp_replace(text, '([.!?]) +', '\\1' || chr(1), 'g'), chr(1)), 1) - 1 AS n FROM documents)
SELECT doc_id, n::INTEGER AS sentence_no, md5(string_agg(s, ' ') OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)) AS digest FROM s""")
def q_sentence_context(t: Tables) -> DataFrame:
    """WIN-08."""
    found = D.context(D.sentences(t.documents.select("doc_id", "text")), ["doc_id"], "sentence_no", "sentence", 1, 1)
    return found.select("doc_id", "sentence_no", F.md5("context").alias("digest"))


@query("SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN length(text) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::INTEGER AS asked FROM conversations")
def q_carry_forward(t: Tables) -> DataFrame:
    """WIN-10."""
    asked = t.conversations.select("conv_id", "turn", F.when(F.col("role") == "user", F.length("text")).alias("asked"))
    return scan.carried(asked, ["conv_id"], [F.asc("turn")], "asked")


@query("SELECT source, doc_id FROM (SELECT source, doc_id, sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id DESC) - n_chars AS before FROM documents) WHERE before <= 15000")
def q_running_budget(t: Tables) -> DataFrame:
    """WIN-13: from the back, as long as what came before is within the budget."""
    return scan.budgeted(t.documents.select("source", "doc_id", "n_chars"), ["source"], [F.desc("doc_id")], F.col("n_chars"), 15000).select("source", "doc_id")


_STOP = "max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@query(f"SELECT user_id, event_id FROM (SELECT user_id, event_id, {_STOP} AS s FROM events) WHERE s = 0")
def q_stop_marker(t: Tables) -> DataFrame:
    """WIN-12: rows before the first that stops."""
    return scan.until(t.events.select("user_id", "event_id", "event_type", "ts"), ["user_id"], [F.asc("ts")], F.col("event_type") == "purchase").select("user_id", "event_id")


@query("SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events")
def q_json_get(t: Tables) -> DataFrame:
    """JSN-01, JSN-02."""
    return t.events.select("event_id", F.from_json("props", "k long").k.alias("k"))


@query("SELECT l_orderkey, coalesce(sum(l_quantity) FILTER (WHERE l_returnflag = 'A'), 0) + coalesce(sum(l_quantity) FILTER (WHERE l_returnflag = 'R'), 0) AS total FROM lineitem GROUP BY 1 HAVING count(*) FILTER (WHERE l_returnflag IN ('A', 'R')) > 0")
def q_participants_sum(t: Tables) -> DataFrame:
    """AGG-16: parts that are missing count as 0, unless all are."""
    parts = t.lineitem.groupBy("l_orderkey").agg(*[F.sum(F.when(F.col("l_returnflag") == f, F.col("l_quantity"))).alias(f) for f in "AR"])
    return parts.where("A IS NOT NULL OR R IS NOT NULL").select("l_orderkey", (F.coalesce("A", F.lit(0.0)) + F.coalesce("R", F.lit(0.0))).alias("total"))


@query("SELECT l_returnflag AS flag, round(100 * sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) / sum(l_quantity), 4) AS pct FROM lineitem GROUP BY 1")
def q_ratio_of_total(t: Tables) -> DataFrame:
    """AGG-17, MATH-01."""
    part = F.sum(F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).otherwise(0))
    return t.lineitem.groupBy(F.col("l_returnflag").alias("flag")).agg(F.round(F.try_divide(100 * part, F.sum("l_quantity")), 4).alias("pct"))


_HEADS = "(SELECT user_id, ts AS h, event_id AS head FROM events WHERE event_type = 'purchase')"


@query(f"SELECT event_id, arg_min(head, struct_pack(d := abs(epoch_us(ts) - epoch_us(h)), h := head)) AS nearest FROM events JOIN {_HEADS} USING (user_id) WHERE event_type = 'view' GROUP BY 1")
def q_nearest_year(t: Tables) -> DataFrame:
    """JN-28: the nearest of another kind of row by one look back and one ahead, with no pairs made."""
    w = Window.partitionBy("user_id").orderBy("ts")
    head = F.when(F.col("event_type") == "purchase", F.struct(F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), F.col("event_id").alias("head")))
    e = t.events.withColumn("h", head)
    near = [F.last("h", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.first("h", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))]
    both = e.select("event_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), F.filter(F.array(*near), lambda x: x.isNotNull()).alias("near")).where("event_type = 'view' AND size(near) > 0")
    return both.select("event_id", F.array_min(F.transform("near", lambda x: F.struct(F.abs(x.at - F.col("us")).alias("d"), x.head.alias("head")))).head.alias("nearest"))


_NAMES = "c_mktsegment AS category, c_name, c_acctbal"


@query(f"SELECT {_NAMES} FROM customer WHERE c_mktsegment NOT ILIKE '%build%' AND c_mktsegment NOT ILIKE '%machin%' AND (c_name ILIKE '%1%' OR c_name ILIKE '%7%')")
def q_status_filters(t: Tables) -> DataFrame:
    """FLT-06 to FLT-09."""
    seg, name = F.col("c_mktsegment"), F.col("c_name")
    return t.customer.where(~seg.ilike("%build%") & ~seg.ilike("%machin%") & (name.ilike("%1%") | name.ilike("%7%"))).select(seg.alias("category"), "c_name", "c_acctbal")


@query("SELECT c_custkey, c_acctbal FROM customer WHERE nullif(c_mktsegment, 'BUILDING') IS DISTINCT FROM 'MACHINERY'")
def q_null_safe_split(t: Tables) -> DataFrame:
    """FLT-15: a null isn't the value, so it stays."""
    return t.customer.where(~F.nullif("c_mktsegment", F.lit("BUILDING")).eqNullSafe(F.lit("MACHINERY"))).select("c_custkey", "c_acctbal")


@query("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def q_distinct_values(t: Tables) -> DataFrame:
    """AGG-27, SET-04."""
    return t.orders.select("o_orderstatus", "o_orderpriority").distinct()


def numbered(df: DataFrame, order: list[Column], coarse: Column, name: str = "position") -> DataFrame:
    """Every row with its place in a sort of the whole table, without one task that has it all.

    coarse: a value that never falls along the order and that few rows share. Rows are counted
    by it, the few counts are summed up, and rows are numbered within their value."""
    binned = df.withColumn("_bin", coarse)
    counts = binned.groupBy("_bin").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")
    met = binned.join(counts.select("_bin", before.alias("_before")), "_bin")
    return met.withColumn(name, (F.col("_before") + F.row_number().over(Window.partitionBy("_bin").orderBy(*order))).cast("long")).drop("_bin", "_before")


@query("SELECT c_custkey, row_number() OVER (ORDER BY c_mktsegment NULLS FIRST, c_acctbal DESC NULLS LAST, c_custkey) AS position FROM customer")
def q_sorted(t: Tables) -> DataFrame:
    """SRT-02: all rows, each with its place in a sort by several keys."""
    balance = F.floor(-F.col("c_acctbal") / 10)
    coarse = F.struct(F.col("c_mktsegment").alias("a"), F.col("c_acctbal").isNull().alias("b"), balance.alias("c"))
    return numbered(t.customer, [F.asc_nulls_first("c_mktsegment"), F.desc_nulls_last("c_acctbal"), F.asc("c_custkey")], coarse).select("c_custkey", "position")


@query("SELECT l_suppkey, max(CASE WHEN y = 1995 THEN q END) AS y1995, max(CASE WHEN y = 1996 THEN q END) AS y1996, max(CASE WHEN y = 1997 THEN q END) AS y1997 FROM (SELECT l_suppkey, year(l_shipdate) AS y, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2) GROUP BY 1")
def q_multi_year(t: Tables) -> DataFrame:
    """RSH-03: years as columns; the list of years is given, so no job looks for it."""
    by_year = t.lineitem.groupBy("l_suppkey", F.year("l_shipdate").alias("y")).agg(F.sum("l_quantity").alias("q"))
    return by_year.groupBy("l_suppkey").pivot("y", [1995, 1996, 1997]).agg(F.max("q")).toDF("l_suppkey", "y1995", "y1996", "y1997")


@query("SELECT o_orderkey, m AS metric, v AS value FROM (SELECT o_orderkey, 'price' AS m, o_totalprice AS v FROM orders UNION ALL SELECT o_orderkey, 'year', year(o_orderdate)::DOUBLE FROM orders)")
def q_unpivot(t: Tables) -> DataFrame:
    """RSH-04."""
    o = t.orders.select("o_orderkey", F.col("o_totalprice").alias("price"), F.year("o_orderdate").cast("double").alias("year"))
    return o.unpivot("o_orderkey", ["price", "year"], "metric", "value")


@query("SELECT max(length(c_name)) ::INTEGER AS c_name, max(length(c_mktsegment))::INTEGER AS c_mktsegment FROM customer")
def q_column_widths(t: Tables) -> DataFrame:
    """AGG-24."""
    return t.customer.agg(*[F.max(F.length(c)).alias(c) for c in ("c_name", "c_mktsegment")])


@query("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'N/A' ELSE CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) || ' M' END AS shown, 'Article ' || CAST(c_nationkey AS VARCHAR) AS label FROM customer")
def q_display(t: Tables) -> DataFrame:
    """PRJ-07, PRJ-08."""
    shown = F.when(F.col("c_acctbal") < 0, "N/A").otherwise(F.concat(F.floor("c_acctbal").cast("string"), F.lit(" M")))
    return t.customer.select("c_custkey", shown.alias("shown"), F.concat(F.lit("Article "), F.col("c_nationkey").cast("string")).alias("label"))


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_acctbal < 0 OR nullif(c_mktsegment, 'BUILDING') IS NULL")
def q_missing_report(t: Tables) -> DataFrame:
    """DQ-01: rows that lack one of two metrics."""
    return t.customer.where((F.col("c_acctbal") < 0) | F.nullif("c_mktsegment", F.lit("BUILDING")).isNull()).select("c_custkey", "c_name", "c_mktsegment")


# Table changes: a target and a source cut out of one table.
_T = "(SELECT c_custkey AS k, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS v FROM customer WHERE c_custkey % 4 <> 0)"
_S = "(SELECT c_custkey AS k, 'new' AS name, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal * 2 END AS v FROM customer WHERE c_custkey % 2 = 0)"


def _target(t: Tables) -> DataFrame:
    return t.customer.where("c_custkey % 4 <> 0").selectExpr("c_custkey AS k", "c_name AS name", "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS v")


def _source(t: Tables) -> DataFrame:
    return t.customer.where("c_custkey % 2 = 0").selectExpr("c_custkey AS k", "'new' AS name", "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal * 2 END AS v")


@query(f"SELECT * FROM {_T} t WHERE k NOT IN (SELECT k FROM {_S}) UNION ALL SELECT * FROM {_S} s")
def q_upsert_replace(t: Tables) -> DataFrame:
    """SNK-06."""
    return merge.upsert_replace(_target(t), _source(t), ["k"])


@query(f"SELECT coalesce(t.k, s.k) AS k, t.name, CASE WHEN s.k IS NOT NULL THEN s.v ELSE t.v END AS v FROM {_T} t FULL JOIN {_S} s ON t.k = s.k")
def q_upsert(t: Tables) -> DataFrame:
    """SNK-07, SNK-08."""
    return merge.upsert(_target(t), _source(t), ["k"], ["v"])


def _update_sql(change: str) -> str:
    return f"SELECT t.k, t.name, {change} AS v FROM {_T} t LEFT JOIN {_S} s ON t.k = s.k"


@query(_update_sql("CASE WHEN s.k IS NOT NULL THEN s.v ELSE t.v END"))
def q_update_overwrite(t: Tables) -> DataFrame:
    """SNK-09, SNK-10."""
    return merge.update(_target(t), _source(t), ["k"], ["v"])


@query(_update_sql("coalesce(s.v, t.v)"))
def q_coalesce_merge(t: Tables) -> DataFrame:
    """SNK-11, SNK-12, SNK-15."""
    return merge.update(_target(t), _source(t), ["k"], ["v"], "found")


@query(_update_sql("coalesce(t.v, s.v)"))
def q_fill_only(t: Tables) -> DataFrame:
    """SNK-13."""
    return merge.update(_target(t), _source(t), ["k"], ["v"], "fill")


@query(f"SELECT k, min(name) AS name, min(v) AS v FROM {_S} s WHERE k NOT IN (SELECT k FROM {_T}) GROUP BY k")
def q_insert_new(t: Tables) -> DataFrame:
    """SNK-05, STM-01, JN-30."""
    return merge.insert_new(_target(t), _source(t), ["k"])


@query(f"SELECT * FROM {_T} t WHERE k % 10 <> 2 UNION ALL SELECT * FROM {_S} s WHERE k % 10 = 2")
def q_replace_keys(t: Tables) -> DataFrame:
    """SNK-17 by group."""
    g = lambda d: d.withColumn("g", F.col("k") % 10)
    return merge.replace_keys(g(_target(t)), g(_source(t)).where("g = 2"), ["g"]).drop("g")


@query(f"""WITH t AS (SELECT * FROM {_T}), p AS (SELECT k AS dup, k // 10 * 10 + 1 AS orig FROM t WHERE k % 10 IN (2, 3) AND k // 10 * 10 + 1 IN (SELECT k FROM t)),
d AS (SELECT orig, arg_max(v, dup) FILTER (WHERE v IS NOT NULL) AS v FROM t JOIN p ON k = dup GROUP BY orig)
SELECT t.k, t.name, coalesce(d.v, t.v) AS v FROM t LEFT JOIN d ON k = orig WHERE k NOT IN (SELECT dup FROM p)""")
def q_merge_dupes(t: Tables) -> DataFrame:
    """SNK-18."""
    rows = _target(t)
    orig = F.expr("k div 10 * 10 + 1")
    pairs = rows.where("k % 10 IN (2, 3)").select(F.col("k").alias("dup"), orig.alias("orig"))
    pairs = pairs.join(rows.select(F.col("k").alias("orig")), "orig", "left_semi").select("dup", "orig")
    return merge.merge_duplicates(rows, pairs, "k", ["v"])


@query("SELECT p_partkey, CASE WHEN p_name ILIKE '%2%' THEN 2.0 WHEN p_name ILIKE '%1%' THEN 1.0 ELSE p_retailprice END AS price FROM part")
def q_update_like(t: Tables) -> DataFrame:
    """SNK-14: of several patterns the last."""
    patterns = t.spark.createDataFrame([("1", 1.0, 1), ("2", 2.0, 2)], "pattern string, value double, ord int")
    return merge.update_like(t.part.select("p_partkey", "p_name", F.col("p_retailprice").alias("price")), patterns, "p_name", "price").select("p_partkey", "price")


@query("SELECT c_mktsegment AS category, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS names FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def q_ordered_distinct(t: Tables) -> DataFrame:
    """AGG-22, ARR-05: distinct names in order; the pairs are made distinct before they are gathered."""
    pairs = t.orders.select("o_custkey", "o_orderpriority").distinct().join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    return pairs.groupBy(F.col("c_mktsegment").alias("category")).agg(F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ", ").alias("names"))


@query("SELECT user_id, arg_min(event_type, ts) AS first_type, arg_max(event_type, ts) AS last_type FROM events GROUP BY 1")
def q_first_last_wins(t: Tables) -> DataFrame:
    """AGG-20, AGG-21, WIN-09."""
    return t.events.groupBy("user_id").agg(F.min_by("event_type", "ts").alias("first_type"), F.max_by("event_type", "ts").alias("last_type"))


@query("WITH c AS (SELECT user_id, event_type, count(*) AS n, min(ts) AS f FROM events GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, f) AS k FROM c) SELECT user_id, string_agg(event_type, ', ' ORDER BY k) FILTER (WHERE k <= 3) AS top FROM r GROUP BY 1")
def q_most_common(t: Tables) -> DataFrame:
    """AGG-13, AGG-14, ARR-01: by count, of equals the one seen first; counted before it is ranked."""
    n = t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.min("ts").alias("f"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "f", "event_type")))
    return n.groupBy("user_id").agg(F.array_join(F.transform(F.slice(ranked, 1, 3), lambda x: x.event_type), ", ").alias("top"))


_SCORED = "(SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS s FROM orders)"


@query(f"SELECT o_orderkey, s, row_number() OVER (ORDER BY s DESC NULLS LAST, o_orderkey) AS place FROM {_SCORED}")
def q_nulls_last(t: Tables) -> DataFrame:
    """SRT-03, SRT-05: all rows, missing values in the last places."""
    scored = t.orders.selectExpr("o_orderkey", "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS s")
    coarse = F.struct(F.col("s").isNull().alias("a"), F.coalesce(F.floor(-F.col("s") / 100), F.floor(F.col("o_orderkey") / 1000)).alias("b"))
    return numbered(scored, [F.desc_nulls_last("s"), F.asc("o_orderkey")], coarse, "place")


@query(f"SELECT o_orderkey, s FROM {_SCORED} ORDER BY s DESC NULLS LAST, o_orderkey LIMIT 5")
def q_top_five(t: Tables) -> DataFrame:
    """SRT-04, SRT-12, SRC-24: a report of the first five."""
    return t.orders.selectExpr("o_orderkey", "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS s").orderBy(F.desc_nulls_last("s"), "o_orderkey").limit(5)


@query("SELECT o_custkey FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) = 2")
def q_subset(t: Tables) -> DataFrame:
    """SET-02: keys that have all of a set of values."""
    need = ["1-URGENT", "2-HIGH"]
    has = F.collect_set("o_orderpriority").alias("has")
    return t.orders.where(F.col("o_orderpriority").isin(need)).groupBy("o_custkey").agg(has).where(F.size(F.array_except(F.array(*map(F.lit, need)), F.col("has"))) == 0).select("o_custkey")


@query("SELECT c_name, o_orderkey, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F' AND (o_totalprice = 100.0 OR o_totalprice < 5000)")
def q_anomalies(t: Tables) -> DataFrame:
    """FLT-04, FLT-05, JN-05, JN-31, DQ-05."""
    odd = t.orders.where((F.col("o_orderstatus") == "F") & ((F.col("o_totalprice") == 100.0) | (F.col("o_totalprice") < 5000)))
    return odd.join(t.customer.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey")).select("c_name", "o_orderkey", "o_totalprice")


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND regexp_matches(c_name, '(?i)customer.*[13]$')")
def q_headline_filter(t: Tables) -> DataFrame:
    """FLT-12, FLT-14: a list, and a pattern in any case; no match for null."""
    return t.customer.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & F.coalesce(F.col("c_name").rlike("(?iu)customer.*[13]$"), F.lit(False))).select("c_custkey", "c_name")
