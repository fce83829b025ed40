"""Key figures by geometry: numbers belong to the nearest year header (EX-13, JN-28)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlake.functions.numbers import signed
from fundlake.functions.text import let
from fundlake.sources.documents import layout_rows

# Words of a page with the table, and of each metric's row.
TABLE_WORDS = "kerncijfers|meerjarenoverzicht|sleutelcijfers|ontwikkeling"
METRICS = {
    "beleggingsrendement_pct": "beleggingsrendement|rendement",
    "economische_dekkingsgraad_pct": "actuele dekkingsgraad|economische dekkingsgraad",
    "nominale_dekkingsgraad_pct": "nominale dekkingsgraad",
    "beleidsdekkingsgraad_pct": "beleidsdekkingsgraad",
    "reele_dekkingsgraad_pct": "reële dekkingsgraad|reele dekkingsgraad",
    "indexatieverlening_pct": "indexatie|toeslag|verhoging",
    "cpi_pct": "prijsinflatie|cpi|consumentenprijsindex|prijsstijging",
}


def key_figures(spans: DataFrame, first: int = 20) -> DataFrame:
    """(doc_id, year, one column a metric) from spans of the first pages.

    A page counts if it has a table word and both 2022 and 2023. Its header is
    the topmost row with three years of 2020 to 2024 or more; below it each
    number of a metric's row goes to the year nearest in x, of equals the
    leftmost. Of several values the first by page, height and x stays. Pages
    after the first that gives 2023 any value other than 0 don't count. Spans are
    shuffled once, by document."""
    by_doc = layout_rows(spans.where(F.col("page_no") < first).repartition("doc_id"))  # all that follows stays where its document is
    row = F.struct("y", "items", F.lower(F.array_join(F.transform("items", lambda i: i.text), " ")).alias("line"))
    pages = by_doc.groupBy("doc_id", "page_no").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    whole = F.array_join(F.transform("rows", lambda r: r.line), "\n")
    pages = pages.where(whole.rlike(TABLE_WORDS) & whole.contains("2022") & whole.contains("2023"))
    headers = F.filter(F.transform("rows", lambda r: F.struct(r.y.alias("y"), F.filter(r["items"], lambda i: i.text.rlike("^202[0-4]$")).alias("years"))), lambda h: F.size(h.years) >= 3)
    pages = pages.withColumn("head", F.get(headers, 0)).where("head IS NOT NULL")
    bare = lambda t: F.trim(F.replace(t, F.lit("%"), F.lit("")))
    near = lambda cell: F.array_min(F.transform("head.years", lambda h: F.struct(F.abs(h.x - cell.x).alias("d"), h.x.alias("x"), h.text.alias("year"))))["year"].cast("int")
    named = lambda line: F.filter(F.array(*[F.when(line.rlike(words), F.lit(metric)) for metric, words in METRICS.items()]), lambda m: m.isNotNull())

    def cells(r: Column) -> Column:
        numbers = F.transform(F.filter(r["items"], lambda i: bare(i.text).rlike(r"^-?\d+[,.]?\d*$")), lambda i: F.struct(near(i).alias("year"), r.y.alias("y"), i.x.alias("x"), signed(i.text).alias("value")))
        return let(named(r.line), lambda metrics: F.when(F.size(metrics) > 0, F.struct(metrics.alias("metrics"), numbers.alias("numbers"))))

    found = F.filter(F.transform(F.filter("rows", lambda r: r.y > F.col("head.y")), cells), lambda x: x.isNotNull())
    each = pages.select("doc_id", "page_no", F.explode(found).alias("f")).select("doc_id", "page_no", F.col("f.numbers").alias("numbers"), F.explode("f.metrics").alias("metric"))
    values = each.select("doc_id", "page_no", "metric", F.explode("numbers").alias("v")).select("doc_id", "page_no", "metric", "v.*").where("value IS NOT NULL")
    firsts = values.groupBy("doc_id", "page_no", "year", "metric").agg(F.min_by("value", F.struct("y", "x")).alias("value"))
    stop = F.min(F.when((F.col("year") == 2023) & (F.col("value") != 0), F.col("page_no"))).over(Window.partitionBy("doc_id"))
    kept = firsts.withColumn("stop", stop).where("stop IS NULL OR page_no <= stop")
    return kept.groupBy("doc_id", "year").agg(*[F.min_by(F.when(F.col("metric") == m, F.col("value")), F.when(F.col("metric") == m, F.col("page_no"))).alias(m) for m in METRICS])
