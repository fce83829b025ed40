"""Running values over groups that no task could hold (WIN-10, WIN-12, WIN-13; places in a sort of a whole table).

A window with PARTITION BY sorts a group in one task. Here rows are dealt by
ranges of (group, order) instead, so a large group is cut into blocks in its
order. Each block keeps its own running values and leaves one state: its sum, last
value, largest. A window over the states, a row for each block of a group, says
what stands before a block, and that is put before the block's own values.

The rows are written once between the two passes, in the session's shared
folder: both see the same blocks, and a lost executor costs a block.

Edge cases: null groups are a group of their own; nulls stand in the order as
asked for. Rows with the same place in the order stay in one block, in any
order, as in a window by rows. An empty table gives an empty result. Columns may
have any names but those that begin with an underscore here.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlake.operators.lineage import cut

#: Kinds of running value: within rows in order, and of what stands before and a block's own.
_WITHIN = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min, "last": lambda c: F.last(c, ignorenulls=True)}


def _joined(kind: str, before: Column, own: Column) -> Column:
    if kind in ("sum", "count"):
        return F.when(before.isNull(), own).otherwise(before + F.coalesce(own, F.lit(0)))
    return {"max": F.greatest, "min": F.least, "last": lambda b, o: F.coalesce(o, b)}[kind](before, own)


def dealt(df: DataFrame, by: Sequence[str], order: Sequence[Column], blocks: int | None = None) -> DataFrame:
    """df with _block: ranges of (group, order), of about the same size."""
    n = blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *by, *order).withColumn("_block", F.spark_partition_id())


def scan(df: DataFrame, by: Sequence[str], order: Sequence[Column], blocks: int | None = None, **values: tuple[str, Column]) -> DataFrame:
    """df with a running value up to and with each row: name=(kind, column); kinds: sum, count, max, min, last (that isn't null)."""
    if not values or any(kind not in _WITHIN for kind, _ in values.values()):
        raise ValueError(f"a running value is one of {', '.join(_WITHIN)}")
    inside = Window.partitionBy(*by, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = {f"_{name}": _WITHIN[kind](c).over(inside) for name, (kind, c) in values.items()}
    rows = cut(dealt(df, by, order, blocks).withColumns({**own, "_at": F.row_number().over(inside)}))
    # A block's last row has its state.
    states = rows.groupBy(*by, "_block").agg(*[F.max_by(f"_{name}", "_at").alias(f"_{name}") for name in values])
    earlier = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    over = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min, "last": _WITHIN["last"]}
    before = states.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.col("_block").alias("_b"), *[over[kind](f"_{name}").over(earlier).alias(f"_before_{name}") for name, (kind, _) in values.items()])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)], F.col("_block") == F.col("_b"))
    met = rows.join(before, same)
    return met.select(*df.columns, *[_joined(kind, F.col(f"_before_{name}"), F.col(f"_{name}")).alias(name) for name, (kind, _) in values.items()])


def budgeted(df: DataFrame, by: Sequence[str], order: Sequence[Column], size: Column, budget: float, blocks: int | None = None) -> DataFrame:
    """WIN-13: rows of each group in order, as long as what came before is within the budget."""
    run = scan(df.withColumn("_size", size), by, order, blocks, _total=("sum", F.col("_size")))
    return run.where(F.coalesce(F.col("_total") - F.coalesce("_size", F.lit(0)), F.lit(0)) <= budget).select(*df.columns)


def until(df: DataFrame, by: Sequence[str], order: Sequence[Column], stop: Column, blocks: int | None = None) -> DataFrame:
    """WIN-12: rows of each group in order, before the first that stops."""
    run = scan(df, by, order, blocks, _stopped=("max", F.coalesce(stop, F.lit(False)).cast("int")))
    return run.where("_stopped = 0").select(*df.columns)


def carried(df: DataFrame, by: Sequence[str], order: Sequence[Column], column: str, blocks: int | None = None) -> DataFrame:
    """WIN-10: a column's last value so far that isn't null."""
    run = scan(df, by, order, blocks, _held=("last", F.col(column)))
    return run.select(*[F.col("_held").alias(c) if c == column else F.col(c) for c in df.columns])


def positions(df: DataFrame, order: Sequence[Column], name: str = "position", blocks: int | None = None) -> DataFrame:
    """df with each row's place in a sort of the whole table, from 1."""
    return scan(df, [], order, blocks, **{name: ("count", F.lit(1))})
