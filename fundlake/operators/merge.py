"""Table changes as whole new DataFrames: upserts, updates, fills, merges of duplicates (SNK-..).

A target keeps its columns and their order. Keys are compared null-safe only
where said; a source is expected to hold a key once unless an order is given.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.operators.contain import join_holding


def last_by(source: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row for each key: the last in the order, ties broken by all columns (AGG-21)."""
    rest = [c for c in source.columns if c not in keys]
    return source.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order, *[c for c in rest if c not in order])).alias("_last")).select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])


def add_columns(df: DataFrame, **types: str) -> DataFrame:
    """SNK-02: missing columns are added as nulls, existing ones stay."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in types.items() if c not in df.columns})


def set_column(df: DataFrame, name: str, value: object) -> DataFrame:
    """SNK-03: add the column, or reset it in all rows."""
    return df.withColumn(name, F.lit(value))


def insert_new(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SNK-05, STM-01: rows of keys that the target lacks, one for each key (the least row)."""
    rest = [c for c in source.columns if c not in keys]
    one = source.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_x")).select(*keys, *[F.col(f"_x.{c}").alias(c) for c in rest]) if rest else source.distinct()
    return one.join(target.select(*keys).distinct(), list(keys), "left_anti")


def upsert_replace(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SNK-06: whole rows of the source take the place of the target's."""
    return target.join(source.select(*keys), list(keys), "left_anti").unionByName(source, allowMissingColumns=True).select(*target.columns)


def _matched(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str], how: str) -> DataFrame:
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in columns], F.lit(True).alias("_hit"))
    return target.join(s, list(keys), how)


#: How a column of a matched row changes.
_CHANGES = {
    "overwrite": lambda c: F.when(F.col("_hit"), F.col(f"_s_{c}")).otherwise(F.col(c)),
    "found": lambda c: F.coalesce(f"_s_{c}", c),
    "fill": lambda c: F.coalesce(c, f"_s_{c}"),
}


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """SNK-07, SNK-08: some columns of matched rows are overwritten (nulls too), new keys come with nulls elsewhere."""
    joined = _matched(target, source, keys, columns, "full")
    return joined.select(*[F.when(F.col("_hit"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns])


def update(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str], mode: str = "overwrite") -> DataFrame:
    """Change columns of matched rows; no row comes or goes.

    overwrite: nulls too (SNK-09, SNK-10). found: only by values (SNK-11, SNK-12, SNK-15). fill: only nulls (SNK-13)."""
    joined = _matched(target, source, keys, columns, "left")
    return joined.select(*[_CHANGES[mode](c).alias(c) if c in columns else F.col(c) for c in target.columns])


def filled(target: DataFrame, source: DataFrame, keys: Sequence[str], column: str) -> Column | DataFrame:
    """How many rows a fill of this column changes (SNK-13)."""
    return _matched(target, source, keys, [column], "inner").agg(F.count_if(F.col(column).isNull() & F.col(f"_s_{column}").isNotNull()).alias("n_filled"))


def tracked(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str], mode: str = "overwrite") -> DataFrame:
    """``upsert`` (mode upsert) or ``update`` with a column _change: inserted, updated, filled or kept, told by the same join that makes the change.

    Counted in flight (``plans.pipeline.store``) it says what a write did without a second pass. Updated: any of the columns is unlike before; filled: and was null."""
    if mode == "upsert":
        joined = _matched(target.withColumn("_own", F.lit(True)), source, keys, columns, "full")
        new = {c: F.when(F.col("_hit"), F.col(f"_s_{c}")).otherwise(F.col(c)) for c in columns}
    else:
        joined = _matched(target.withColumn("_own", F.lit(True)), source, keys, columns, "left")
        new = {c: _CHANGES[mode](c) for c in columns}
    unlike = {c: ~new[c].eqNullSafe(F.col(c)) for c in columns}
    some = reduce(lambda a, b: a | b, unlike.values())
    filled_ = reduce(lambda a, b: a & b, [~unlike[c] | F.col(c).isNull() for c in columns])
    change = F.when(F.col("_own").isNull(), "inserted").when(~some, "kept").when(filled_, "filled").otherwise("updated")
    return joined.select(*[new[c].alias(c) if c in columns else F.col(c) for c in target.columns], change.alias("_change"))


def update_like(target: DataFrame, patterns: DataFrame, name: str, column: str) -> DataFrame:
    """SNK-14: (pattern, value, ord) for all rows whose name has the pattern; of several the last counts.

    A pattern may have wildcards within. Names meet it by its longest plain part and are then held against all of it."""
    plain = F.split(F.lower("pattern"), r"\\.|[%_]")
    part = F.array_max(F.transform(plain, lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))["x"]
    p = patterns.select(F.col("pattern").alias("_p"), F.struct(F.col("ord").alias("o"), F.col("value").alias("v")).alias("_x"))
    own = target.select(F.col(name).alias("_n")).where("_n IS NOT NULL").distinct()
    met = join_holding(p.withColumnRenamed("_p", "pattern"), part, own, F.lower("_n"))
    hits = met.where(F.ilike(F.col("_n"), F.concat(F.lit("%"), F.col("pattern"), F.lit("%")))).groupBy("_n").agg(F.max("_x").alias("_x"))
    return update(target, hits.select(F.col("_n").alias(name), F.col("_x.v").alias(column)), [name], [column])


def replace_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SNK-17: all rows of the source's keys go, its rows come."""
    return target.join(source.select(*keys).distinct(), list(keys), "left_anti").unionByName(source)


def merge_duplicates(df: DataFrame, pairs: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """SNK-18: pairs (dup, orig): values of duplicates go to the original, then duplicates go.

    A duplicate's value wins over the original's; of several the last by duplicate id that isn't null."""
    dups = df.join(pairs, F.col(key) == F.col("dup")).groupBy("orig").agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("dup"))).alias(c) for c in columns])
    kept = df.join(pairs.select(F.col("dup").alias(key)), key, "left_anti")
    return update(kept, dups.withColumnRenamed("orig", key), [key], columns, "found")
