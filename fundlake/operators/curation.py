"""Curation steps that combine operators: regulator sheets, planning lists, row aliases, link walks, gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlake.functions import dates, names
from fundlake.functions import numbers as N
from fundlake.functions.text import contains_any, first_where, group, groups, strip
from fundlake.operators import extract as X
from fundlake.operators import contain, merge, resolve, scan
from fundlake.operators.lineage import cut
from fundlake.sources import documents as D


def equity_share_of_lines(pages: DataFrame) -> DataFrame:
    """EX-03: (doc_id, pct) from 5 to 95: a line that names equity, or a line up to two away that is a percentage alone.

    The first by page, line and neighbour counts (WIN-04, WIN-09)."""
    w = Window.partitionBy("doc_id", "page_no").orderBy("line_no").rowsBetween(-2, 2)
    lines = D.lines(pages).withColumn("around", F.collect_list("line").over(w))
    number = r"(\d+[.,]?\d*)\s*%"
    own = N.comma_decimal(group(F.col("line"), number))
    plausible = lambda v: v.between(5, 95)
    near = first_where(F.transform("around", lambda x: N.comma_decimal(group(strip(x), rf"^{number}$"))), plausible)
    pct = F.when(F.col("line").rlike(number), F.when(plausible(own), own)).otherwise(near)
    found = lines.where(F.col("line").rlike("(?iu)aandelen|zakelijk")).withColumn("pct", pct).where("pct IS NOT NULL")
    return found.groupBy("doc_id").agg(F.min_by("pct", F.struct("page_no", "line_no")).alias("pct"))


def flat_figures(text: Column, label: str) -> Column:
    """EX-14: (year, value) pairs: the years of a line that has three or more, with the numbers after the label in order."""
    years = groups(group(text, r"((?:202[0-4]\s+){2,}202[0-4])"), r"(202[0-4])")
    values = groups(group(text, rf"(?iu){label}\s+((?:-?\d+[.,]?\d*%?\s+){{2,4}}-?\d+[.,]?\d*%?)"), r"(-?\d+[.,]?\d*)")
    return F.arrays_zip(years.alias("year"), F.transform(values, N.comma_decimal).alias("value"))


def planning_list(lines: DataFrame) -> DataFrame:
    """EX-40: (doc_id, line_no, date, fund) of dated lines: a date holds until the next one, a line with 'totaal' ends the list."""
    w = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    text = strip(F.col("line"))
    date = dates.leading_date(text)
    rest = F.when(date.isNotNull(), F.regexp_replace(strip(F.substring(text, F.length(date) + 1, 1 << 30)), r"^\d+\s+", "")).otherwise(text)
    rows = lines.where(F.length(text) > 0).select("doc_id", "line_no", date.alias("own"), rest.alias("fund"))
    held = rows.withColumn("date", F.last("own", ignorenulls=True).over(w))
    stop = F.max((F.col("date").isNotNull() & F.lower("fund").contains("totaal")).cast("int")).over(w)
    return held.withColumn("stop", stop).where("stop = 0 AND date IS NOT NULL AND fund <> ''").select("doc_id", "line_no", "date", "fund")


def directory(lines: DataFrame) -> DataFrame:
    """EX-41: (name, category) of a directory's fund lines; the category is the last header's (WIN-10), 'General' before any."""
    kind = X.fund_line(F.col("line"))
    w = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    marked = lines.select("doc_id", "line_no", strip(F.col("line")).alias("name"), kind.alias("kind"))
    head = F.coalesce(F.last(F.when(F.col("kind") == "header", F.col("name")), ignorenulls=True).over(w), F.lit("General"))
    return marked.withColumn("category", head).where("kind = 'fund'").select("doc_id", "line_no", "name", "category")


def merge_regulator(funds: DataFrame, sheet: DataFrame, columns: list[str], source: str = "DNB Appendix") -> DataFrame:
    """IMP-03: the sheet's rows update the funds they match, nulls too; of several rows the last by name. Others become new funds.

    New ids follow the largest in the order of the names."""
    found = resolve.match_regulator(sheet, funds.select("id", "name"))
    rows = sheet.join(found, "name")
    last = rows.where("id IS NOT NULL").groupBy("id").agg(F.max_by(F.struct(*columns), "name").alias("x")).select("id", "x.*")
    updated = merge.update(funds, last, ["id"], columns)
    top = funds.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"))
    fresh = rows.where("id IS NULL").drop("id").dropDuplicates(["name"])
    placed = scan.positions(fresh, [F.asc("name")], "_place").join(F.broadcast(top), F.col("_place").isNotNull())  # one row beside each
    numbered = placed.withColumn("id", F.col("top") + F.col("_place")).drop("top", "_place").withColumn("data_source", F.lit(source))
    return updated.unionByName(numbered, allowMissingColumns=True).select(*funds.columns)


def status_of(funds: DataFrame, closed: DataFrame) -> DataFrame:
    """NRM-07: 'Gesloten' for funds that are marked so themselves or match a closed name, else 'Open'."""
    f = funds.select("id", F.col("name").alias("fund"))
    hits = resolve.contained_pairs(closed.select("name").distinct(), f, names.clean_name, 5).select("id").distinct().withColumn("hit", F.lit(True))
    return funds.join(hits, "id", "left").withColumn("status", F.when(F.col("hit") | names.is_closed(F.col("name")), "Gesloten").otherwise("Open")).drop("hit")


def by_row_alias(funds: DataFrame, rows: DataFrame, aliases: DataFrame) -> DataFrame:
    """JN-20 to JN-22: (id, cells) of the last row that an alias or containment gives each fund; rows: (row_no, label, cells).

    aliases: (in_name, in_row), all lower case; they go before containment. Names, labels and aliases meet by ``contain.holding``."""
    last = F.max(F.struct("row_no", "cells")).alias("x")
    f = funds.select("id", F.lower("name").alias("n"))
    own = f.select("n").distinct()
    r = rows.select("row_no", F.lower("label").alias("l"), "cells")
    of_row = contain.join_holding(aliases.select("in_row").distinct(), F.col("in_row"), r, F.col("l")).groupBy("in_row").agg(last)
    ruled = contain.join_holding(aliases.select("in_name", "in_row"), F.col("in_name"), own, F.col("n")).join(of_row, "in_row").groupBy("n").agg(F.max("x").alias("ruled"))
    once = lambda c: F.explode(F.array(names.clean_name(F.col(c))))  # noqa: E731  # else each filter on the name cleans it anew
    labels = r.withColumn("b", once("l")).groupBy("b").agg(last)
    cleaned = own.withColumn("a", once("n"))
    plain = cleaned.join(resolve.text_pairs(cleaned, labels, 4).hint("merge"), "a").join(labels.hint("merge"), "b").groupBy("n").agg(F.max("x").alias("plain"))
    best = F.coalesce("ruled.cells", "plain.cells")
    return f.join(ruled.hint("merge"), "n", "left").join(plain.hint("merge"), "n", "left").where("ruled IS NOT NULL OR plain IS NOT NULL").select("id", best.alias("cells"))


def table_fees(tables: DataFrame) -> DataFrame:
    """SRC-14, EX-29: (doc_id, fee) of tables (doc_id, page_no, table_no, rows array<array<string>>): the first row's that has one."""
    cells = tables.select("doc_id", "page_no", "table_no", F.posexplode("rows").alias("row_no", "cells"))
    fees = cells.withColumn("fee", X.performance_fee_of_row(F.col("cells"))).where("fee IS NOT NULL")
    return fees.groupBy("doc_id").agg(F.min_by("fee", F.struct("page_no", "table_no", "row_no")).alias("fee"))


def walk_links(links: DataFrame, start: DataFrame, most: int = 25, priority: tuple[str, ...] = ()) -> DataFrame:
    """STM-03: (site, url, step) reached from start (site, url) over landed links (page, url), at most so many a site.

    Step by step; within a step addresses with a priority word go first, then by address. The
    limit is the feature: a crawl's budget. A site is walked until it has no new page or its
    budget is used up, however long its chains are."""
    edges = links.select(F.col("page").alias("url"), F.col("url").alias("to"))
    first = contains_any(F.lower("url"), priority).cast("int") if priority else F.lit(0)
    order = Window.partitionBy("site").orderBy("step", F.desc("first"), "url")
    within = lambda df: df.withColumn("n", F.row_number().over(order)).where(F.col("n") <= most).drop("n")
    seen, step = cut(within(start.select("site", "url").distinct().withColumns({"step": F.lit(0), "first": first}))), 0
    while True:
        step += 1
        room = seen.groupBy("site").agg(F.count("*").alias("n")).where(F.col("n") < most).select("site")
        new = seen.where(F.col("step") == step - 1).join(room, "site").join(edges, "url").select("site", F.col("to").alias("url")).distinct()
        new = new.join(seen.select("site", "url"), ["site", "url"], "left_anti").withColumns({"step": F.lit(step), "first": first})
        more = cut(within(seen.unionByName(new)))
        if not more.where(F.col("step") == step).take(1):
            return more.drop("first")
        seen = more


def unextracted(funds: DataFrame, extracted: DataFrame, files: DataFrame) -> DataFrame:
    """DQ-04, JN-10, JN-12: funds with a report file and no extracted value."""
    filed = files.select(F.regexp_extract(F.regexp_extract("path", r"([^/]*)$", 1), r"^(\d+)_", 1).try_cast("long").alias("id"))
    known = extracted.select(F.col("fund_id").alias("id")).where("id IS NOT NULL")
    return funds.join(known, "id", "left_anti").join(filed, "id", "left_semi")
