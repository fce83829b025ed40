"""Documents as pages, lines, sentences and spans (SRC-..), from text that has landed.

A page is a row (doc_id, page_no, text); page numbers and line numbers start at 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundlake.functions.text import contains_any, strip


def csv(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """SRC-05."""
    return spark.read.schema(schema).option("header", header).csv(path)


def files(spark: SparkSession, path: str, glob: str = "*.pdf") -> DataFrame:
    """SRC-23: file names with the fund and year in them; contents aren't read unless asked for."""
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    return found.withColumns({"name": name, "fund_id": F.regexp_extract(name, r"^(\d+)_", 1).try_cast("long"), "year": F.regexp_extract(name, r"_(\d{4})\.[a-z]+$", 1).try_cast("int")})


def is_pdf(content: Column, length: Column, least: int = 50 * 1024, content_type: Column | None = None) -> Column:
    """SNK-23: the bytes of a real report: the PDF mark, long enough, not served as a web page."""
    ok = (F.substring(content, 1, 5) == F.lit(b"%PDF-")) & (length >= least)
    return ok if content_type is None else ok & ~F.coalesce(F.lower(content_type).contains("html"), F.lit(False))


def page_dump(spark: SparkSession, path: str) -> DataFrame:
    """SRC-32: (doc_id, page_no, text) of text files with lines '--- PAGE n ---'."""
    whole = spark.read.text(path, wholetext=True).withColumn("doc_id", F.regexp_extract(F.input_file_name(), r"([^/]*)$", 1))
    return split_pages(whole.select("doc_id", F.col("value").alias("text")))


def split_pages(docs: DataFrame) -> DataFrame:
    mark = r"--- PAGE (\d+) ---"
    numbers = F.regexp_extract_all("text", F.lit(mark), F.lit(1))
    texts = F.slice(F.split("text", mark, -1), 2, F.size(numbers))
    return docs.select("doc_id", F.explode(F.arrays_zip(numbers.alias("n"), texts.alias("t"))).alias("p")).select("doc_id", F.col("p.n").cast("int").alias("page_no"), F.col("p.t").alias("text"))


def whole_text(pages: DataFrame, separator: str = "", first: int | None = None, lower: bool = False) -> DataFrame:
    """SRC-08 to SRC-10: (doc_id, text) of all or the first pages in order."""
    some = pages if first is None else pages.where(F.col("page_no") < first)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("page_no", "text"))), lambda x: x.text)
    text = F.array_join(ordered, separator)
    return some.groupBy("doc_id").agg((F.lower(text) if lower else text).alias("text"))


def focus_pages(pages: DataFrame, words: Sequence[str]) -> DataFrame:
    """SRC-11, EX-44: pages that hold a word; a test by plain containment before any expensive pattern."""
    return pages.where(contains_any(F.lower("text"), words))


def last_pages(pages: DataFrame, words: Sequence[str], most: int = 50, budget: int = 15_000) -> DataFrame:
    """SRC-12, WIN-13: of the last pages those with a word, from the back until the text exceeds the budget, marked, in order."""
    back = Window.partitionBy("doc_id").orderBy(F.desc("page_no"))
    recent = pages.withColumn("_r", F.row_number().over(back)).where(F.col("_r") <= most)
    marked = focus_pages(recent, words).withColumn("text", F.concat(F.lit("--- PAGE "), F.col("page_no").cast("string"), F.lit(" ---\n"), F.col("text")))
    before = F.coalesce(F.sum(F.length("text")).over(back.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return whole_text(marked.withColumn("_b", before).where(F.col("_b") <= budget), "\n")


def page_window(pages: DataFrame, first: int, last: int, chars: int | None = None) -> DataFrame:
    """SRC-15."""
    some = pages.where(F.col("page_no").between(first, last))
    return some if chars is None else some.withColumn("text", F.substring("text", 1, chars))


def lines(pages: DataFrame) -> DataFrame:
    """D7: one row a line."""
    keys = [c for c in pages.columns if c != "text"]
    return pages.select(*keys, F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))


def sentences(docs: DataFrame) -> DataFrame:
    """D8: split at spaces after a full stop, exclamation or question mark."""
    keys = [c for c in docs.columns if c != "text"]
    return docs.select(*keys, F.posexplode(F.split("text", r"(?<=[.!?]) +", -1)).alias("sentence_no", "sentence"))


def context(rows: DataFrame, by: Sequence[str], order: str, text: str, before: int, after: int, separator: str = " ") -> DataFrame:
    """WIN-01 to WIN-08: each row with its neighbours' text, joined in order."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(-before, after)
    return rows.withColumn("context", F.array_join(F.collect_list(text).over(w), separator))


def grep(rows: DataFrame, by: Sequence[str], order: str, text: str, pattern: str, before: int = 0, after: int = 0, most: int | None = None) -> DataFrame:
    """EX-43, EX-45: rows that match, with context; the first so many of each group."""
    found = context(rows, by, order, text, before, after).where(F.col(text).rlike(pattern))
    if most is None:
        return found
    return found.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(order))).where(F.col("_n") <= most).drop("_n")


def layout_rows(spans: DataFrame, step: float = 5.0) -> DataFrame:
    """SRC-13: spans (doc_id, page_no, x, y, text) gathered into table rows by rounded height, from left to right."""
    y = (F.bround(F.col("y") / step) * step).alias("y")
    return spans.select("doc_id", "page_no", y, "x", strip(F.col("text")).alias("text")).groupBy("doc_id", "page_no", "y").agg(F.array_sort(F.collect_list(F.struct("x", "text"))).alias("items"))


def markdown_records(rows: DataFrame) -> DataFrame:
    """SRC-17: lines (doc_id, line_no, line) of a file of '## name' records: name, allocation_pct, notes."""
    w = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    heading = F.when(F.col("line").startswith("## "), strip(F.substring("line", 4, 1 << 30)))
    noted = F.when(F.col("line").contains("**Strategy Notes:**"), F.lit(True)).when(F.col("line").startswith("## "), F.lit(False))
    marked = rows.withColumn("name", F.last(heading, ignorenulls=True).over(w)).withColumn("in_notes", F.last(noted, ignorenulls=True).over(w)).where("name IS NOT NULL")
    share = F.regexp_extract("line", r"\*\*Equity Allocation:\*\*\s*([\d.]+)%", 1).try_cast("double")
    note = F.when(F.col("in_notes") & F.col("line").startswith(">"), F.struct("line_no", strip(F.regexp_replace("line", "^> ?", "")).alias("t")))
    got = marked.groupBy("doc_id", "name").agg(F.max(share).alias("allocation_pct"), F.array_sort(F.collect_list(note)).alias("n"))
    return got.select("doc_id", "name", "allocation_pct", F.nullif(F.array_join(F.transform("n", lambda x: x.t), " "), F.lit("")).alias("notes"))


def header_labels(first: Sequence[str | None], second: Sequence[str | None]) -> list[str]:
    """SRC-07: the second of two header rows counts where it has a label."""
    return [(b or "").strip() or (a or "").strip() or f"column_{i}" for i, (a, b) in enumerate(zip(first, second, strict=True))]


def labelled_numbers(docs: DataFrame) -> DataFrame:
    """SRC-26: each non-empty line's label and its last word as a whole number."""
    from fundlake.functions.numbers import last_token

    return lines(docs).where(F.length(strip(F.col("line"))) > 0).withColumn("value", last_token(F.col("line"))).withColumn("label", F.rtrim(F.regexp_replace("line", r"\S+\s*$", "")))


def parse_reply(c: Column, schema: str) -> Column:
    """SRC-31, JSN-01: JSON from a model's reply, without the fence it may stand in; null fields if it isn't JSON."""
    return F.from_json(strip(F.regexp_replace(strip(c), r"^```[a-z]*\s*|\s*```$", "")), schema)
