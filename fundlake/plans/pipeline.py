"""Named stages run in order: logged, timed, stopped at the first failure (ORC-01, ORC-02, SNK-28)."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger("fundlake")
Stage = Callable[[SparkSession, dict[str, DataFrame]], dict[str, DataFrame]]


CHANGES = ("inserted", "updated", "filled", "kept")


def store(df: DataFrame, path: str, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """SNK-05, SNK-13, AGG-25: a table written once and read back, with its rows and other counts taken while they pass.

    A column _change (``merge.tracked``) is counted by its values and not stored."""
    told = {}
    if "_change" in df.columns:
        told = {c: F.count_if(F.col("_change") == c).alias(c) for c in CHANGES}
    seen = Observation()
    df.observe(seen, F.count("*").alias("rows"), *told.values(), *[c.alias(n) for n, c in counts.items()]).drop("_change").write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.drop("_change").schema).parquet(path), dict(seen.get)


def run(spark: SparkSession, tables: dict[str, DataFrame], stages: Sequence[tuple[str, Stage | None]], root: str | None = None, counts: dict[str, dict[str, int]] | None = None) -> dict[str, DataFrame]:
    """Each stage gets the tables so far and gives those it adds or replaces; a stage that is None is skipped with a warning.

    root: a folder where each stage's tables are written, each once; their counts go to the log, and to counts by stage and table if asked for."""
    tables = dict(tables)
    for name, stage in stages:
        if stage is None:
            log.warning("skipped %s: there is none", name)
            continue
        began = time.monotonic()
        try:
            made = stage(spark, tables)
            if root is not None:
                for table, df in made.items():
                    made[table], found = store(df, f"{root}/{name}/{table}")
                    log.info("%s: %s: %s", name, table, ", ".join(f"{n} {k}" for k, n in found.items()))
                    if counts is not None:
                        counts[f"{name}.{table}"] = found
            tables |= made
        except Exception:
            log.exception("failed %s", name)
            raise
        log.info("success %s (%.1fs)", name, time.monotonic() - began)
    return tables


def equity_strategy(spark: SparkSession, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Report texts (fund_id, text) to regional weights: extract, then impute, in one plan without stored steps."""
    from fundlake.operators import extract as X
    from fundlake.operators.regions import regional_weights

    low = F.lower("text")
    found = tables["report_texts"].select(
        "fund_id",
        X.equity_share(low).alias("allocation_pct"),
        X.management_style(low).alias("management_style"),
        X.factor_style(low).alias("factor_investing"),
        X.esg_focus(low).alias("esg_focus"),
        X.regions_named(low).alias("geographic_allocation"),
        X.weights_text(X.region_weights(low)).alias("explicit_geographic_weights"),
    )
    return {"equity_strategy": found, "equity_strategies": regional_weights(found)}
