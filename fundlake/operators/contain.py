"""Which texts hold which: a containment join by keys, for parts of any length.

Postings list the wholes by their runs of characters. A part meets the wholes by
one of its runs of the longest of ``SIZES`` that it has, the one that the fewest
wholes have, and is then looked for in them; a part shorter than four characters
is a run itself, and the empty part is in every whole. No pair of texts is looked
at that does not share such a run.

Texts are made distinct first and kept in the checkpoint folder, so rows that
share a name cost one text, cleaned once. Parts are told apart by their run's size:
sizes whose parts have ``FEW`` characters at most in all go to every task, and the
wholes stay where they are; so do wholes that are as few. Else the postings are
shuffled; short runs are in many wholes, so theirs are dealt to several tasks by a
hash of the whole (``SALTS``), and a part asks all of them. An exploded table is
many times what Spark takes it for, so these joins are told not to broadcast it.

Edge cases: a null text holds nothing and is in nothing; the empty text is in
every text; equal texts hold each other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.operators.lineage import cut

#: Sizes of the runs, and tasks that the postings of a run of each size are dealt to.
SALTS = {0: 64, 1: 64, 2: 32, 3: 8, 4: 4, 6: 4}
SIZES = tuple(SALTS)
#: Characters, in all, of the texts that go to every task.
FEW = 1 << 17


def _runs(c: Column, size: int) -> Column:
    """The different runs of so many characters of a text."""
    if size == 0:
        return F.array(F.lit(""))
    n = F.length(c) - size + 1
    return F.when(n >= 1, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(c, i, size)))).otherwise(F.array().cast("array<string>"))


def _size(c: Column) -> Column:
    """The size of a part's runs."""
    return F.array_max(F.filter(F.array(*map(F.lit, SIZES)), lambda k: k <= F.length(c)))


def _met(parts: DataFrame, wholes: DataFrame, sizes: list[int], few_parts: bool, few_wholes: bool) -> DataFrame:
    """(part, whole) for the parts of these sizes of runs; parts: (part, size)."""
    parts = parts.where(F.col("size").isin(sizes))
    of_whole = wholes.select("whole", F.explode(F.concat(*[_runs(F.col("whole"), k) for k in sizes])).alias("run"))
    own_runs = reduce(lambda x, k: x.when(F.col("size") == k, _runs(F.col("part"), k)), sizes[1:], F.when(F.col("size") == sizes[0], _runs(F.col("part"), sizes[0])))
    of_part = parts.select("part", F.explode(own_runs).alias("run"))
    asked = of_whole.join(F.broadcast(of_part.select("run").distinct()), "run") if few_parts else of_whole
    counts = asked.groupBy("run").agg(F.count("*").alias("n"))
    known = of_part.join(F.broadcast(counts) if few_parts or few_wholes else counts.hint("merge"), "run")
    rarest = known.groupBy("part").agg(F.min(F.struct("n", "run")).alias("x"), F.count("*").alias("found"))
    every = F.array_max(F.array(*[F.when(F.length("x.run") == k, F.size(_runs(F.col("part"), k))) for k in sizes]))
    own = rarest.where(F.col("found") == every).select("part", "x.run")  # a run of the part that no whole has rules the part out
    if few_parts:
        met = of_whole.join(F.broadcast(own), "run")
    elif few_wholes:
        met = own.join(F.broadcast(of_whole), "run")
    else:
        salts = F.element_at(F.create_map(*[F.lit(x) for k in sizes for x in (k, SALTS[k])]), F.length("run"))
        dealt = of_whole.withColumn("salt", F.pmod(F.xxhash64("whole"), salts).cast("int"))
        met = own.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).join(dealt.hint("merge"), ["run", "salt"])
    return met.where(F.col("whole").contains(F.col("part"))).select("part", "whole")


def holding(parts: DataFrame, wholes: DataFrame) -> DataFrame:
    """(part, whole) of all pairs of which the whole holds the part; parts: (part), wholes: (whole)."""
    parts = cut(parts.select("part").where("part IS NOT NULL").distinct().withColumn("size", _size(F.col("part"))))
    wholes = cut(wholes.select("whole").where("whole IS NOT NULL").distinct())
    found = parts.groupBy("size").agg(F.sum(F.length("part") + 1).alias("chars")).collect()  # as many rows as SIZES at most
    few_wholes = wholes.agg(F.coalesce(F.sum(F.length("whole") + 1), F.lit(0))).first()[0] <= FEW
    few, many, chars = [], [], 0
    for r in sorted(found, key=lambda r: r.chars):
        chars += r.chars
        (few if chars <= FEW else many).append(r["size"])
    met = [_met(parts, wholes, sizes, sizes is few, few_wholes) for sizes in (few, many) if sizes]
    return reduce(DataFrame.union, met) if met else parts.select("part", F.col("part").alias("whole")).where(F.lit(False))


def join_holding(left: DataFrame, part: Column, right: DataFrame, whole: Column) -> DataFrame:
    """The rows of left beside those of right whose text (whole) holds theirs (part); the tables share no column name."""
    a, b = left.withColumn("_part", part), right.withColumn("_whole", whole)
    pairs = holding(a.select(F.col("_part").alias("part")), b.select(F.col("_whole").alias("whole")))
    return a.join(pairs.hint("merge"), F.col("_part") == F.col("part")).join(b.hint("merge"), F.col("whole") == F.col("_whole")).select(*left.columns, *right.columns)
