"""Column functions on text: keyword windows, first and all matches, white space, case.

All are pure expressions: they stay in the JVM and keep rows independent.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def quote(literal: str) -> str:
    """A literal as a Java pattern."""
    return re.sub(r"([\\.\[\]{}()*+?^$|&-])", r"\\\1", literal)


def strip(c: Column) -> Column:
    """Without white space of any kind (Unicode) at both ends; Spark's trim takes spaces alone."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """Runs of white space become one space, none at the ends."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def title_case(c: Column) -> Column:
    """A letter is upper case after any non-letter and lower case after a letter, unlike initcap."""
    pieces = F.regexp_extract_all(F.lower(c), F.lit(r"(?U)\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30))), "")


def group(c: Column, pattern: str, index: int = 1) -> Column:
    """A group of the first match; null if there is none (regexp_extract gives '')."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, index))


def groups(c: Column, pattern: str, index: int = 1) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(index))


def first(values: Column) -> Column:
    return F.get(values, 0)


def first_where(values: Column, keep: Callable[[Column], Column]) -> Column:
    """The first value for which keep holds; null if none."""
    return first(F.filter(values, lambda v: F.coalesce(keep(v), F.lit(False))))


def contains_any(c: Column, words: Sequence[str]) -> Column:
    return F.coalesce(c.rlike("|".join(map(quote, words))), F.lit(False))


def count_words(c: Column, words: Sequence[str]) -> Column:
    """How often any of the words stands by itself, each counted alone."""
    return sum((F.regexp_count(c, F.lit(rf"(?U)\b{quote(w)}\b")) for w in words), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once a row, however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(numbers: Column) -> Column:
    """The running sums of an array, in as many passes over it as its size has binary digits."""

    def further(sums: Column, k: Column) -> Column:
        back = F.slice(F.concat(F.array_repeat(F.lit(0), F.pow(F.lit(2), k).cast("int")), sums), 1, F.size(sums))
        return F.zip_with(sums, back, lambda a, b: a + b)

    return F.aggregate(F.sequence(F.lit(0), F.length(F.bin(F.size(numbers))) - 1), numbers, further)


#: Characters of the pieces out of which windows are cut.
_PIECE = 1024


def _cut(pieces: Column, start: Column, length: Column) -> Column:
    """length characters from start (0: the first) of a text cut into pieces."""
    first, last = F.floor(start / _PIECE).cast("int"), F.floor((start + length - 1) / _PIECE).cast("int")
    held = F.when(last <= first + 1, F.concat(F.coalesce(F.get(pieces, first), F.lit("")), F.when(last > first, F.coalesce(F.get(pieces, last), F.lit(""))).otherwise("")))
    return F.substring(held.otherwise(F.array_join(F.slice(pieces, first + 1, last - first + 1), "")), start - first * _PIECE + 1, length)


def windows(c: Column, pattern: str, before: int, after: int, own: bool = True) -> Column:
    """The text around each match of pattern, in order; neighbours' windows may overlap.

    before, after: characters on either side; own: with the match itself. A
    text takes time in proportion to its length, its matches' and windows'."""
    empty = F.array().cast("array<string>")

    def cut(found: Column, ends: Column, text: Column) -> Column:
        def window(match: Column, end: Column) -> Column:
            lo = F.greatest(end - F.length(match) - before, F.lit(0)) if own or before else end
            hi = end + after if own or after else end - F.length(match)
            return F.when(hi > lo, _cut(text, lo, hi - lo)).otherwise("")

        return F.zip_with(found, ends, window)

    def place(found: Column) -> Column:
        sizes = let(F.split(c, pattern, -1), lambda rest: F.zip_with(found, F.slice(rest, 1, F.size(found)), lambda m, p: F.length(p) + F.length(m)))
        pieces = F.regexp_extract_all(c, F.lit(f"(?s).{{1,{_PIECE}}}"), F.lit(0))
        return F.when(F.size(found) == 0, empty).otherwise(let(let(sizes, running), lambda ends: let(pieces, lambda text: cut(found, ends, text))))

    return F.coalesce(let(F.regexp_extract_all(c, F.lit(f"({pattern})"), F.lit(1)), place), empty)


def keyword_windows(c: Column, words: Sequence[str], before: int, after: int, own: bool = True) -> Column:
    """Windows around each word in turn, each word's in text order."""
    return F.concat(*[windows(c, quote(w), before, after, own) for w in words])


def count_where(values: Column, keep: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(values, lambda v: F.coalesce(keep(v), F.lit(False))))
