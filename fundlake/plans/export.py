"""Frames for people: report lines, sheets, chart data, CSV files (SNK-19 to SNK-27, PRJ-04 to PRJ-09).

Workbooks, documents and pictures are drawn by whatever reads these frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.operators import scan


def move_after(df: DataFrame, column: str, anchor: str) -> DataFrame:
    """PRJ-05: a column right after another, if both are there."""
    if column not in df.columns or anchor not in df.columns:
        return df
    rest = [c for c in df.columns if c != column]
    at = rest.index(anchor) + 1
    return df.select(*rest[:at], column, *rest[at:])


def shown(c: Column, missing: str = "-", decimals: int | None = None, suffix: str = "") -> Column:
    """PRJ-08: a value as text, a literal for null; decimals are rounded half to even."""
    text = c.cast("string") if decimals is None else F.format_string(f"%.{decimals}f", F.bround(c.cast("double"), decimals))
    return F.when(c.isNull(), missing).otherwise(F.concat(text, F.lit(suffix)))


def sheets(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """SNK-22, JN-05: a frame for each table; those of a fund begin with its name and are ordered by it."""
    funds = tables["funds"].select(F.col("id").alias("fund_id"), F.col("name").alias("fund_name"))
    out = {"funds": tables["funds"].orderBy(F.asc_nulls_first("category"), F.desc_nulls_last("aum_euro_bn"), "name")}
    for name, df in tables.items():
        if name != "funds":
            own = df.withColumnRenamed("fund_name", "holding") if "fund_name" in df.columns else df
            out[name] = own.join(funds, "fund_id").select("fund_name", *[c for c in own.columns if c != "fund_id"]).orderBy("fund_name")
    return out


def widths(df: DataFrame, most: int = 50, margin: int = 2) -> DataFrame:
    """AGG-24: a column's width on a sheet, in one pass."""
    return df.agg(*[F.least(F.coalesce(F.max(F.length(F.col(c).cast("string"))), F.lit(0)) + margin, F.lit(most)).alias(c) for c in df.columns])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-19, SNK-21: with a header; append adds files of its own."""
    df.write.mode(mode).option("header", True).csv(path)


def markdown_table(df: DataFrame, columns: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """SNK-24: the lines of a table, bars in values taken out, as (n, line)."""
    cells = [F.replace(F.coalesce(F.col(c).cast("string"), F.lit("NaN")), F.lit("|"), F.lit("")) for c in columns]
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    body = scan.positions(df, [F.asc(c) if isinstance(c, str) else c for c in order], "_n").select(F.col("_n").alias("n"), line.alias("line"))
    head = df.sparkSession.createDataFrame([(-1, "| " + " | ".join(columns) + " |"), (0, "|" + "---|" * len(columns))], "n long, line string")
    return head.union(body).orderBy("n")


def word_rows(funds: DataFrame, columns: Sequence[str]) -> DataFrame:
    """SNK-25: without insurers, nulls shown as a dash."""
    return funds.where(~F.coalesce(F.col("category").contains("Pension Insurers"), F.lit(False))).select(*[shown(F.col(c)).alias(c) for c in columns])


def stacked_bars(weights: DataFrame, order: DataFrame, key: str) -> DataFrame:
    """SNK-26, SRT-11: (key, region, weight_pct) in the order of another frame (key, ord), as a chart stacks them."""
    return weights.join(order, key).orderBy("ord", "region").select(key, "region", "weight_pct")


def pie(df: DataFrame, column: str) -> DataFrame:
    """VIZ: shares of a column's values, nulls left out."""
    n = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return n.orderBy(F.desc("n"), "value")


def scatter(df: DataFrame, x: str, y: str, *more: str) -> DataFrame:
    """VIZ: rows that have both coordinates (FLT-13)."""
    return df.dropna(subset=[x, y]).select(x, y, *more)


def fund_link(name: Column) -> Column:
    """PRJ-06, URL-03."""
    return F.concat(F.lit("/?fund="), F.url_encode(name))
