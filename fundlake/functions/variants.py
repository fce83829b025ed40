"""Replies of unknown shape as VARIANT values (JSN-01 to JSN-03, SRC-30, SRC-31).

A reply is parsed once, without a schema; fields are then taken by path with a
type, and what is not there or not of that type is null. Lists and objects are
spread out to rows with their key and place.

Edge cases: a text that is no JSON is null as a whole; one in a fence (three
back quotes, with or without a language) counts without it. Null stays null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.functions.text import strip


def reply(c: Column) -> Column:
    """SRC-31: the value of a reply's JSON; null if it isn't any."""
    return F.try_parse_json(strip(F.regexp_replace(strip(c), r"^```[a-zA-Z]*\s*|\s*```$", "")))


def field(v: Column, path: str, kind: str = "string") -> Column:
    """JSN-01, JSN-02: the value at a path ($.a.b[0]) as a type; null if there is none, or none of this type."""
    return F.try_variant_get(v, path, kind)


def entries(df: DataFrame, variant: str, path: str = "$") -> DataFrame:
    """JSN-03, SRC-30: df with a row for each entry of the list or object at a path: pos (from 0), key (of an object's entry), value."""
    held = df.withColumn("_v", F.try_variant_get(F.col(variant), path, "variant"))
    return held.lateralJoin(held.sparkSession.tvf.variant_explode(F.col("_v").outer())).drop("_v")
