"""Numbers as Dutch reports write them. Names: NUM-01 and so on in the survey's inventory.

Unparsable text is null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundlake.functions.text import first, first_where, group, strip


def number(c: Column) -> Column:
    """A double, or null; only digits, signs and one point count as a number."""
    return F.when(c.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), c.try_cast("double"))


def comma_decimal(c: Column) -> Column:
    """NUM-01: the comma is the decimal sign, points stay: '1.250' is 1.25."""
    return number(F.replace(strip(c), F.lit(","), F.lit(".")))


def dotted_thousands(c: Column) -> Column:
    """NUM-02: points go, then the comma is the decimal sign: '8.1' is 81."""
    return number(F.replace(F.replace(strip(c), F.lit("."), F.lit("")), F.lit(","), F.lit(".")))


def dutch_number(c: Column) -> Column:
    """NUM-03: of both signs the later is the decimal sign; a sign by itself before three last digits marks thousands."""
    comma, point = c.contains(","), c.contains(".")
    tail = lambda sign: F.length(F.substring_index(c, sign, -1))
    drop = lambda sign: F.replace(c, F.lit(sign), F.lit(""))
    to_point = lambda x: F.replace(x, F.lit(","), F.lit("."))
    clean = (
        F.when(comma & point & (tail(",") < tail(".")), to_point(drop(".")))
        .when(comma & point, drop(","))
        .when(comma & (tail(",") == 3), drop(","))
        .when(comma, to_point(c))
        .when(point & (tail(".") == 3), drop("."))
        .otherwise(c)
    )
    return number(clean)


def count(c: Column) -> Column:
    """NUM-04: a whole number without points and spaces, at least 10 and no year from 2010 to 2030."""
    n = F.translate(c, ". ", "").try_cast("long")
    return F.when((n >= 10) & ~n.between(2010, 2030), n)


def allocation(mix: Column, words: list[str]) -> Column:
    """NUM-05: of the parts between bars, the first that has one of the words and a number."""
    parts = F.split(F.lower(mix), r"\|")
    has = lambda p: F.exists(F.array(*map(F.lit, words)), lambda w: p.contains(w))
    return first(F.filter(F.transform(F.filter(parts, has), lambda p: comma_decimal(F.regexp_extract(p, r"(\d+(?:[.,]\d+)?)", 1))), lambda v: v.isNotNull()))


def mix_share(mix: Column, word: str) -> Column:
    """NUM-06: the number after the word with no digit between, anywhere in the cell."""
    return comma_decimal(group(F.lower(mix), rf"{word}[^\d]*(\d+(?:[.,]\d+)?)"))


def cost(c: Column) -> Column:
    """NUM-07: a whole cell like '0,61%'."""
    return comma_decimal(F.replace(c, F.lit("%"), F.lit("")))


def first_decimal(c: Column) -> Column:
    """NUM-08: the first number with decimals; not of the words none and nan."""
    return F.when(~F.lower(strip(c)).isin("none", "nan"), comma_decimal(group(c, r"(\d+[,.]\d+)")))


def signed(c: Column) -> Column:
    """NUM-09: the first signed decimal or whole number."""
    return comma_decimal(group(c, r"(-?\d+(?:[.,]\d+)?)"))


def coverage(c: Column) -> Column:
    """NUM-10: a percentage from 60 to 250."""
    v = cost(c)
    return F.when(v.between(60, 250), v)


def billions(v: Column, unit: Column) -> Column:
    """NUM-11: by the unit's name, else by size: over a million it is euros, over a hundred it is millions."""
    u = F.lower(F.coalesce(unit, F.lit("")))
    by_size = F.when(v > 1e6, v / 1e9).when(v > 100, v / 1e3).otherwise(v)
    return F.when(u.rlike("miljard|mld|mrd|bn"), v).when(u.rlike("miljoen|mln|milj"), v / 1e3).otherwise(by_size)


def millions(v: Column) -> Column:
    """NUM-12: over a million it is euros, over a thousand it is thousands."""
    cents = lambda x: F.rint(x * 100) / 100  # noqa: E731  # the double itself is rounded; bround rounds its shortest decimal form
    return F.when(v > 1e6, cents(v / 1e6)).when(v > 1e3, cents(v / 1e3)).otherwise(v)


def total_cost(v: Column) -> Column:
    """NUM-13: millions below 100, euros above 100000, else thousands; years are no costs."""
    year = v.between(2010, 2030) | v.between(2.010, 2.030)
    return F.when(year | (v == 0), None).when(v < 100, v).when(v > 1e5, v / 1e6).otherwise(v / 1e3)


def basis_points(v: Column) -> Column:
    """NUM-14: 35 becomes '0.350%'."""
    return F.when(v.isNotNull(), F.format_string("%.3f%%", v / 100))


def thousands(c: Column) -> Column:
    """NUM-15: digits with any separators, in whole thousands."""
    digits = F.translate(c, ".,", "")
    return F.when(digits.rlike(r"^\d+$"), F.bround(digits.try_cast("double") / 1000).cast("long"))


def last_token(c: Column) -> Column:
    """NUM-17: the last word of a line as a whole number without points."""
    return F.replace(F.element_at(F.split(strip(c), r"\s+"), -1), F.lit("."), F.lit("")).try_cast("long")


def first_between(values: Column, low: float, high: float, open_low: bool = False) -> Column:
    """The first of some number texts whose value lies in the bounds."""
    return first_where(F.transform(values, comma_decimal), lambda v: ((v > low) if open_low else (v >= low)) & (v <= high))
