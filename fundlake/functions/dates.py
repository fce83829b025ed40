"""Dates as Dutch pages write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundlake.functions.text import strip

# Month names.
MONTHS = ("januari", "februari", "maart", "april", "mei", "juni", "juli", "augustus", "september", "oktober", "november", "december")


def dutch_date(c: Column) -> Column:
    """DAT-01: an ISO date of the 2020s, or day, month name and year; else null."""
    low = F.lower(strip(c))
    named = F.coalesce(*[F.when(low.contains(m), F.replace(F.replace(low, F.lit(m), F.lit(f"-{i:02d}-")), F.lit(" "), F.lit(""))) for i, m in enumerate(MONTHS, 1)], low)
    clean = F.regexp_replace(named, r"[^\d-]", "")
    iso = low.rlike(r"^202.{7}$") & low.contains("-")
    return F.when(iso, F.try_to_date(low, "yyyy-MM-dd")).otherwise(F.try_to_date(clean, "d-MM-yyyy"))


def date_token(*columns: Column) -> Column:
    """DAT-03: the part before the first space of the first column that isn't null."""
    return F.split_part(F.coalesce(*columns), F.lit(" "), F.lit(1))


def leading_date(c: Column) -> Column:
    """DAT-04: a date like 1-apr-26 at the start of a line."""
    low = F.lower(c)
    return F.when(low.rlike(r"^\d{1,2}-[a-z]{3}-\d{2}"), F.regexp_extract(low, r"^(\d{1,2}-[a-z]{3}-\d{2})", 1))


def year_suffix(title: Column) -> Column:
    """DAT-05 and PRJ-03: the leading whole number of the last four characters, 0 if none, null for null."""
    return F.when(title.isNotNull(), F.coalesce(F.regexp_extract(F.substring(title, -4, 4), r"^\s*([+-]?\d+)", 1).try_cast("int"), F.lit(0)))


def file_year(path: Column) -> Column:
    """The year of a name that ends in _2023.pdf."""
    return F.regexp_extract(path, r"_(\d{4})\.pdf$", 1).try_cast("int")
