"""Filter interaction audit by the subset-zeta transform.

Every document gets a mask: bit i is set if it fails filter i. Spark counts the
documents of each part by mask, which leaves at most 2**n numbers a part
whatever its size. The zeta transform over subsets turns those counts f into

    z[c] = sum of f[m] over the masks m that lie within c

so that the survivors of any set S of filters are z[all - S]. A step of an order
is then a difference of two neighbouring subsets, S and S with one filter more,
for labelled documents just as for all. A filter's Shapley sum over all orders
weighs the difference at S by the number of orders in which exactly S comes
before it: |S|! (n - 1 - |S|)!.

Filters on the text alone are SQL conditions over ``t`` (the text), ``n_words``
and ``n_distinct``. The duplicate filter fails a document whose text a smaller
doc_id has, anywhere in the table: texts are grouped by SHA-256 to their
smallest id, and a document is joined with its own (text, id) pair, so a text
that a third of all rows share is one row of that table and no hot key of the
join. Nothing but digests, ids and masks is shuffled.

Edge cases: a null text counts as empty (no words: it fails a least number of
words, and is a duplicate of other empty texts); a null source is the part of
the empty string. A null doc_id is smaller than nothing and larger than
nothing: its document neither fails the duplicate filter nor makes others fail,
and has no labels. Rows that repeat an id count each; with equal texts none is
a duplicate of the other, as its id is not smaller. If ``labels`` repeats an id,
the document is good (toxic) if any of its rows says so; labels of unknown ids,
null labels and other columns do not matter. An empty table gives an empty
result. Very long texts only take time in proportion to their length.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.llm.scratch import Scratch

#: The filters' letters and failure conditions; the last is the duplicate filter.
CONDITIONS = {
    "A": "n_words < 50",
    "B": "100 * n_distinct < 65 * n_words",
    "C": "100L * length(regexp_replace(t, '[^A-Z]+', '')) > 5L * length(t)",
    "D": "rlike(t, '[#$%&*|]')",
}
DUPLICATE = "E"
WORD = r"[^\x20\x09-\x0D]+"
#: All orders of the filters are listed; more would be 40,320 rows a part and step.
MOST_FILTERS = 7


def masked(docs: DataFrame, conditions: dict[str, str], part: str) -> DataFrame:
    """(doc_id, k, digest, part, mask): mask of the conditions on the text; k stands for the id, and for the text where the id is null."""
    words = f"element_at(transform(array(regexp_extract_all(t, r'{WORD}', 0)), w -> named_struct('n', size(w), 'd', size(array_distinct(w)))), 1)"
    rows = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("t")).withColumn("w", F.expr(words))
    fails = [F.expr(c.replace("n_words", "w.n").replace("n_distinct", "w.d")).cast("int") * (1 << i) for i, c in enumerate(conditions.values())]
    digest = F.unhex(F.sha2(F.col("t").cast("binary"), 256))
    k = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.hex(F.col("digest")))
    return rows.select("doc_id", "part", sum(fails, F.lit(0)).alias("mask"), digest.alias("digest")).withColumn("k", k)


def counted(rows: DataFrame, labels: DataFrame, bit: int) -> DataFrame:
    """(part, mask, n, good, toxic) of ``masked`` rows, with the duplicate filter's bit set and labels counted."""
    firsts = rows.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").cast("string").alias("first")).select("digest", F.concat(F.lit("="), "first").alias("k"), F.lit(True).alias("is_first"))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.concat(F.lit("="), F.col("doc_id").cast("string")).alias("k"))
    marks = marks.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    same = rows.groupBy("k", "digest", "part", "mask").agg(F.count("*").alias("n"))
    told = same.join(firsts, ["digest", "k"], "left").join(marks, "k", "left")
    repeats = F.col("is_first").isNull() & F.startswith("k", F.lit("="))
    whole = F.col("mask") + F.when(repeats, 1 << bit).otherwise(0)
    times = lambda c: F.sum(F.col("n") * F.coalesce(c, F.lit(0)))
    return told.groupBy("part", whole.alias("mask")).agg(F.sum("n").alias("n"), times("good").alias("good"), times("toxic").alias("toxic"))


def zeta(counts: str, bits: int) -> str:
    """SQL of the subset-zeta transform of an array of 2**bits counts."""
    return f"aggregate(sequence(0, {bits - 1}), {counts}, (z, b) -> transform(z, (x, i) -> x + if(i & shiftleft(1, b) != 0, get(z, i - shiftleft(1, b)), 0L)))"


def _shapley(bits: int) -> str:
    """SQL of an array: for each filter what it removes, summed over all orders; z is the transform."""
    whole = (1 << bits) - 1
    weights = ", ".join(f"{factorial(k) * factorial(bits - 1 - k)}L" for k in range(bits))
    gone = f"get(z, {whole} - s) - get(z, {whole} - s - shiftleft(1, b))"
    return f"transform(sequence(0, {bits - 1}), b -> aggregate(sequence(0, {whole}), 0L, (a, s) -> a + if(s & shiftleft(1, b) = 0, get(array({weights}), bit_count(s)) * ({gone}), 0L)))"


def subsets(counts: DataFrame, bits: int) -> DataFrame:
    """A row a part: arrays f, z (all), zg (good) and zt (toxic) indexed by mask, and shapley by filter."""
    held = counts.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("mask", F.struct("n", "good", "toxic")))).alias("at"))  # 2**bits entries at most
    by_mask = lambda c: f"transform(sequence(0, {(1 << bits) - 1}), m -> coalesce(at[m].{c}, 0L))"
    arrays = held.select("part", F.expr(by_mask("n")).alias("f"), F.expr(by_mask("good")).alias("g"), F.expr(by_mask("toxic")).alias("t"))
    moved = arrays.select("part", "f", F.expr(zeta("f", bits)).alias("z"), F.expr(zeta("g", bits)).alias("zg"), F.expr(zeta("t", bits)).alias("zt"))
    return moved.withColumn("shapley", F.expr(_shapley(bits)))


def steps(tables: DataFrame, letters: str) -> DataFrame:
    """A row for each part, order of the filters and step."""
    bits = len(letters)
    orders = ",".join("".join(p) for p in permutations(letters))
    at = lambda letter: f"shiftleft(1, instr('{letters}', {letter}) - 1)"
    rows = tables.withColumn("filter_order", F.explode(F.split(F.lit(orders), ","))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(bits))))
    rows = rows.withColumn("own", F.expr(at("substr(filter_order, step, 1)"))).withColumn("before", F.expr(f"aggregate(slice(split(filter_order, ''), 1, step - 1), 0, (m, c) -> m + {at('c')})"))
    whole = (1 << bits) - 1
    left = lambda z, s: F.expr(f"get({z}, {whole} - ({s}))")
    gone = lambda z: left(z, "before") - left(z, "before + own")
    failing: Column = left("z", "0") - left("z", "own")
    return rows.select(
        "part",
        "filter_order",
        "step",
        left("z", "before + own").alias("kept"),
        gone("z").alias("removed"),
        (failing - gone("z")).alias("redundant"),
        F.expr("get(f, own)").alias("unique_fails"),
        gone("zg").alias("good_lost"),
        gone("zt").alias("toxic_lost"),
        F.expr(f"get(shapley, instr('{letters}', substr(filter_order, step, 1)) - 1)").alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, conditions: dict[str, str] | None = None, duplicate: str = DUPLICATE, part: str = "source") -> DataFrame:
    """What each filter does in every order of the filters, for each part of docs (doc_id, text and the column part); labels: doc_id, quality, toxic."""
    conditions = CONDITIONS if conditions is None else conditions
    letters = "".join(conditions) + duplicate
    if len(set(letters)) != len(conditions) + 1 or len(letters) > MOST_FILTERS:
        raise ValueError(f"up to {MOST_FILTERS} filters, each of one letter of its own")
    rows = Scratch(docs.sparkSession).keep(masked(docs, conditions, part), "audit-masks")
    return steps(subsets(counted(rows, labels, len(conditions)), len(letters)), letters)
