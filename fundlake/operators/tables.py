"""Tables out of a page's layout (SRC-14): from spans with a place to rows of cells.

Rows are the runs of spans along a page's height without a gap above ``step``; a
gap above ``apart`` ends a table. Columns are found by the gaps in a table's
projection on the x axis: where no span of any row with several spans reaches,
for more than ``gap``, a new column begins. A row of one span (a heading, a label
that goes on) shapes no column and stands in the one that begins at or before it.

All of it is running sums over windows of one page, so a page is sorted by
height once, its tables by x once, and nothing is shuffled after the spans have
been dealt by page.

Edge cases: spans without a place or any text do not count; spans of one cell
are joined by x, height and text; equal spans count each. A block of a single row or
column is no table. Pages, and tables on one, are independent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlake.functions.text import contains_any, let, strip

#: Heights that are one row's, that end a table; width between columns; width of a character where spans have no right edge.
STEP, APART, GAP, CHARACTER = 4.0, 25.0, 8.0, 5.0
PAGE = ("doc_id", "page_no")


def _placed(spans: DataFrame, step: float, apart: float) -> DataFrame:
    """Spans with right, row_no on the page, block and the number of spans in their row."""
    text = strip(F.col("text"))
    right = F.coalesce(F.col("right") if "right" in spans.columns else F.lit(None).cast("double"), F.col("x") + F.length(text) * CHARACTER)
    own = spans.select(*PAGE, "x", "y", text.alias("text"), right.alias("right")).where("x IS NOT NULL AND y IS NOT NULL AND text <> ''").repartition(*PAGE)
    by_height = Window.partitionBy(*PAGE).orderBy("y", "x", "text")
    so_far = by_height.rangeBetween(Window.unboundedPreceding, Window.currentRow)  # equal spans are peers
    drop = F.coalesce(F.col("y") - F.lag("y").over(by_height), F.lit(float("inf")))
    numbered = own.withColumn("_drop", drop).withColumns({"row_no": (F.count_if(F.col("_drop") > step).over(so_far) - 1).cast("int"), "block": (F.count_if(F.col("_drop") > apart).over(so_far) - 1).cast("int")})
    return numbered.withColumn("in_row", F.count("*").over(Window.partitionBy(*PAGE, "row_no"))).drop("_drop")


def cells(spans: DataFrame, step: float = STEP, apart: float = APART, gap: float = GAP) -> DataFrame:
    """(doc_id, page_no, block, row_no, col_no, text) of spans (doc_id, page_no, x, y, text and, if known, right)."""
    rows = _placed(spans, step, apart)
    by_x = Window.partitionBy(*PAGE, "block").orderBy("x", "right", "y", "text")
    reach = F.max(F.when(F.col("in_row") > 1, F.col("right"))).over(by_x.rowsBetween(Window.unboundedPreceding, -1))
    begins = (F.col("in_row") > 1) & F.coalesce(F.col("x") > reach + gap, F.lit(True))
    placed = rows.withColumn("_begins", begins).withColumn("col_no", F.greatest(F.count_if("_begins").over(by_x.rangeBetween(Window.unboundedPreceding, Window.currentRow)) - 1, F.lit(0)).cast("int"))
    words = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x", "y", "text"))), lambda s: s["text"]), " ")
    return placed.groupBy(*PAGE, "block", "row_no", "col_no").agg(words.alias("text"))


def tables(spans: DataFrame, step: float = STEP, apart: float = APART, gap: float = GAP) -> DataFrame:
    """(doc_id, page_no, table_no, rows array<array<string>>); a cell without spans is empty."""
    rows = cells(spans, step, apart, gap).groupBy(*PAGE, "block", "row_no").agg(F.collect_list(F.struct("col_no", "text")).alias("at"), F.max("col_no").alias("last"))
    found = rows.groupBy(*PAGE, "block").agg(F.array_sort(F.collect_list(F.struct("row_no", "at"))).alias("at"), F.max("last").alias("last"))
    filled = lambda at: F.transform(F.sequence(F.lit(0), F.col("last")), lambda c: F.coalesce(F.try_element_at(at, c), F.lit("")))
    grid = F.transform("at", lambda r: let(F.map_from_entries(r["at"]), filled))
    kept = found.where((F.size("at") > 1) & (F.col("last") > 0))
    number = F.row_number().over(Window.partitionBy(*PAGE).orderBy("block")) - 1
    return kept.select(*PAGE, number.cast("int").alias("table_no"), grid.alias("rows"))


def keyword_pages(spans: DataFrame, words: Sequence[str], first: int = 100, step: float = STEP) -> DataFrame:
    """Spans of those of the first pages on which a row, read from left to right, has one of the words in any case."""
    rows = _placed(spans.where(F.col("page_no") < first), step, APART)
    line = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x", "y", "text"))), lambda s: F.lower(s["text"])), " ")
    pages = rows.groupBy(*PAGE, "row_no").agg(line.alias("line")).where(contains_any(F.col("line"), words)).select(*PAGE).distinct()
    return spans.join(pages, list(PAGE), "left_semi")
