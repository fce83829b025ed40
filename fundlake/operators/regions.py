"""Regional weights: decoding cells, imputing, normalising, pivoting (IMP-01, AGG-18, AGG-19, RSH-01)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.functions.text import strip

# Default market weights of regions; a region not named here weighs 10.
STANDARD = {"North America": 63.0, "Europe": 16.0, "Emerging Markets": 11.0, "Other": 10.0, "Netherlands": 1.0}
WORLD = ("North America", "Europe", "Emerging Markets", "Other")
_TYPE = "array<struct<region:string,weight:double>>"


def _name(c: Column) -> Column:
    return F.when(c == "Pacific/Other", "Other").otherwise(c)


def explicit(cell: Column) -> Column:
    """AGG-18: (region, weight) pairs of 'Europe: 40.0, ..'; made to sum to 100 if they don't between 90 and 110."""
    parts = F.filter(F.split(cell, ","), lambda p: p.contains(":"))
    pairs = F.transform(parts, lambda p: F.struct(_name(strip(F.split_part(p, F.lit(":"), F.lit(1)))).alias("region"), strip(F.substring_index(p, ":", -1)).try_cast("double").alias("weight")))
    pairs = F.filter(pairs, lambda x: x.weight.isNotNull())
    total = F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x.weight)
    off = (total > 0) & ((total < 90) | (total > 110))
    return F.when(off, F.transform(pairs, lambda x: F.struct(x.region.alias("region"), (x.weight / total * 100).alias("weight")))).otherwise(pairs)


def implied(cell: Column) -> Column:
    """AGG-19: world weights for Global or for all three main regions, else shares of the default weights of those named."""
    parts = F.transform(F.split(cell, ","), strip)
    table = F.create_map(*[F.lit(x) for pair in STANDARD.items() for x in pair])
    of = lambda p: F.coalesce(F.try_element_at(table, p), F.lit(10.0))
    total = F.aggregate(parts, F.lit(0.0), lambda a, p: a + of(p))
    world = F.array(*[F.struct(F.lit(r).alias("region"), F.lit(STANDARD[r]).alias("weight")) for r in WORLD])
    all_three = F.size(F.array_except(F.array(*map(F.lit, WORLD[:3])), parts)) == 0
    return F.when(F.array_contains(parts, "Global") | all_three, world).otherwise(F.transform(parts, lambda p: F.struct(_name(p).alias("region"), (of(p) / total * 100).alias("weight"))))


def regional_weights(strategy: DataFrame) -> DataFrame:
    """IMP-01: (fund_id, region, weight_pct) of equity_strategy rows: explicit weights if there are any, else implied ones."""
    own = F.length(strip(F.col("explicit_geographic_weights"))) > 0
    weights = F.when(own, explicit(F.col("explicit_geographic_weights"))).when(F.length("geographic_allocation") > 0, implied(F.col("geographic_allocation")))
    return strategy.select("fund_id", F.explode(weights).alias("x")).select("fund_id", F.col("x.region").alias("region"), F.bround("x.weight", 2).alias("weight_pct"))


def pivot_weights(weights: DataFrame, key: str, regions: Sequence[str]) -> DataFrame:
    """RSH-01: one column a region; a (key, region) that occurs twice is an error, as in a strict pivot."""
    once = F.when(F.count("*") > 1, F.raise_error(F.lit("duplicate (key, region)")).cast("double")).otherwise(F.max("weight_pct"))
    return weights.groupBy(key, "region").agg(once.alias("w")).groupBy(key).pivot("region", list(regions)).agg(F.first("w"))
