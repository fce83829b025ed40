"""Mixing sources to target weights by entropy balancing.

Each constraint says how many tokens of a group of documents the mix must take.
Of all document rates r that meet the constraints, the one closest to 1 in
token-weighted relative entropy is exponentially tilted, r = exp(sum of the
multipliers of the document's groups), and the multipliers minimise a convex
dual, found by Newton steps. Where groups share documents (``balance``) Spark
sums tokens by cell (a distinct set of groups; rates are equal within one) once,
and each step sums gradient and Hessian over the cells. Where they don't, as
with sources, the Hessian is diagonal and each group's row takes its own steps
where it lies (``newton``): no job and no row on the driver for a step.

Rates become whole copies (``copies_of``), tier by tier from a source's largest
documents to its smallest. Within a tier all take the same number of copies,
and those whose hash lies below a threshold one more; the threshold is where
the tier's tokens, summed by hash in two rounds of bins, reach what is due. What
a tier takes too much or too little is made up by the next, so a source misses
its target by about half of one of its small documents, and no sort or window
ever holds a source's documents in one place.

Rules (``mix_sources``): a document's size is its number of words. Sources in
code point order, null last, weigh ``WEIGHTS`` in turn and share all tokens by
weight; a target stops at ``MAX_COPIES`` times its source's size and the excess
is shared again by weight until none is above.

Edge cases: a null or empty text has size 0 and nothing is taken of it. Null
doc_ids are documents like others. Rows with the same id (or none) and the same
text share one hash, and so take the same copies, unless all of them together
weigh more than ``HEAVY`` of what is due: then each has a hash of its own place in
the input, so that a group is taken in part and its source meets its target as
if all were different. Reruns over the same files with the same settings agree;
which of equal rows are taken makes no other difference. Very long texts are
documents of the first tier. An empty table gives an empty result. Sources with no words have target 0. Other columns pass by;
columns named like those that are added are replaced. Up to ``MAX_SOURCES``
sources' goals are broadcast; beyond, documents meet them in a join that deals
each source to ``SALTS`` tasks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlake.llm.scratch import Scratch

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
#: Shares of its source's target from which a document belongs to the first, second, ... tier.
TIERS = (0.05, 0.01, 0.002)
#: Sources whose goals and thresholds are broadcast (some 20 MB), and tasks a source is dealt to beyond.
MAX_SOURCES, SALTS = 100_000, 64
#: Share of what is due from which equal rows are told apart.
HEAVY = 0.0005
#: Newton steps at most; far from the goal each moves the multiplier by 1.
STEPS = 64
#: Groups of overlapping constraints whose dense Hessian is solved at once.
MAX_GROUPS = 4096
#: Bins of a round; two rounds tell apart 1 / _BIN ** 2 of a tier, far less than a document of all but the largest sources.
_BIN = 1 << 12
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str | Column = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_COPIES) -> DataFrame:
    """(source, source_size) -> also target: weight shares of all tokens, none above most times its size.

    Sources at their cap are those with the smallest size by weight, so the water level is found in one sorted pass."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")).cast("double"))
    order = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    full = Window.partitionBy()
    # The level if this source and all later ones are below their caps.
    level = (F.sum("source_size").over(full) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("w").over(after)
    stated = weighed.withColumn("level", level).withColumn("below", F.col("level") * F.col("w") <= most * F.col("source_size"))
    water = F.min(F.when(F.col("below"), F.struct(F.col("source_size") / F.col("w"), "level"))).over(full)["level"]
    return stated.select("source", "source_size", *[c for c in sizes.columns if c not in ("source", "source_size")], F.when(F.col("source_size") == 0, 0.0).otherwise(F.least(F.lit(float(most)) * F.col("source_size"), F.coalesce(water, F.lit(float("inf"))) * F.col("w"))).alias("target"))


def balance(cells: DataFrame, wanted: dict[str, float], steps: int = 60, tolerance: float = 1e-9) -> dict[str, float]:
    """Multipliers of the dual for cells (cell, groups array<string>, tokens) and the tokens wanted of each group.

    A step that overshoots is halved until the dual falls; the dual is convex, so this ends."""
    names = sorted(k for k, v in wanted.items() if v > 0)
    if not names:
        return {}
    at, goal, x = {k: i for i, k in enumerate(names)}, np.array([wanted[k] for k in names]), np.zeros(len(names))
    spark = cells.sparkSession

    def sums(x: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, dict]:
        table = F.broadcast(spark.createDataFrame(list(zip(names, x.tolist(), strict=True)), "g string, x double"))
        tilt = cells.select("cell", F.explode("groups").alias("g")).join(table, "g").groupBy("cell").agg(F.exp(F.sum("x")).alias("rate"))
        taken = cells.join(tilt, "cell").select("groups", (F.col("tokens") * F.col("rate")).alias("t"))
        pairs = taken.select("t", F.explode("groups").alias("a"), "groups").select("t", "a", F.explode("groups").alias("b"))
        diagonal, off = np.zeros(len(names)), {}
        for r in pairs.groupBy("a", "b").agg(F.sum("t").alias("t")).collect():  # a row for each two groups that share documents
            if r.a == r.b and r.a in at:
                diagonal[at[r.a]] = r.t
            elif r.a in at and r.b in at:
                off[at[r.a], at[r.b]] = r.t
        total = diagonal.sum() if not off else taken.agg(F.sum("t")).first()[0]
        return total - float(goal @ x), diagonal - goal, diagonal, off

    dual, gradient, diagonal, off = sums(x)
    for _ in range(steps):
        if np.abs(gradient).max() <= tolerance * goal.max():
            break
        if off:
            if len(names) > MAX_GROUPS:
                raise ValueError(f"{len(names)} overlapping groups; a Hessian of at most {MAX_GROUPS} is solved")
            hessian = np.diag(diagonal)
            for (i, j), v in off.items():
                hessian[i, j] = v
            step = np.linalg.lstsq(hessian, -gradient, rcond=1e-12)[0]
        else:
            step = -gradient / np.maximum(diagonal, 1e-300)
        size = 1.0
        while True:
            new = sums(x + size * step)
            if new[0] <= dual + 1e-4 * size * float(gradient @ step) + 1e-9 * abs(dual) or size < 1e-6:
                break
            size /= 2
        x = x + size * step
        dual, gradient, diagonal, off = new
    return dict(zip(names, x.tolist(), strict=True))


def newton(tokens: Column, wanted: Column) -> Column:
    """The rate of a group that shares no document with another: exp(x) for the x that minimises tokens * exp(x) - wanted * x."""
    step = lambda x, _: F.when(F.abs(tokens * F.exp(x) - wanted) <= 1e-12 * wanted, x).otherwise(x - 1 + wanted / (tokens * F.exp(x)))
    x = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), F.lit(0.0), step)
    return F.when((wanted > 0) & (tokens > 0), F.exp(x)).otherwise(0.0)


def _meet(docs: DataFrame, rows: DataFrame, on: list[str], salt: str, few: bool) -> DataFrame:
    """Documents with the row of their source; rows are one a source, or one for each of its tiers."""
    if few:
        return docs.join(F.broadcast(rows), on)
    dealt = rows.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return docs.withColumn("_salt", F.pmod(F.col(salt), F.lit(SALTS)).cast("int")).join(dealt, [*on, "_salt"]).drop("_salt")


def _threshold(tier: DataFrame, state: DataFrame, few: bool, work: Scratch) -> DataFrame:
    """state (g, base, extra, low = 0) with low raised until the tokens of tier (g, u, size) below it are about extra."""
    for step in (_BIN, 1):
        inside = _meet(tier, state, ["g"], "u", few).where((F.col("u") >= F.col("low")) & (F.col("u") < F.col("low") + step * _BIN))
        bins = inside.groupBy("g", F.floor((F.col("u") - F.col("low")) / step).alias("bin")).agg(F.sum("size").alias("tokens"), F.first("extra").alias("extra"))
        run = bins.withColumn("sum", F.sum("tokens").over(Window.partitionBy("g").orderBy("bin")))  # at most _BIN rows a group
        # Bins that are taken whole; the one that is crossed is looked into, and at last taken if that comes nearer.
        whole = F.col("sum") <= F.col("extra") if step > 1 else F.col("sum") - F.col("tokens") / 2 <= F.col("extra")
        fit = run.groupBy("g").agg(F.min(F.when(~whole, F.col("bin"))).alias("crossed"), F.coalesce(F.max(F.when(whole, F.col("sum"))), F.lit(0)).alias("took"))
        state = work.keep(
            state.join(fit, "g", "left").select("g", "base", (F.col("extra") - F.coalesce("took", F.lit(0))).alias("extra"), (F.col("low") + F.coalesce("crossed", F.lit(_BIN)) * step).cast("long").alias("low")),
            "mix-threshold",
        )
    return state


def _tier(size: Column, due: Column) -> Column:
    return sum(((size < share * due).cast("int") for share in TIERS), F.lit(0))


def copies_of(docs: DataFrame, goals: DataFrame, most: int, work: Scratch) -> DataFrame:
    """(g, tier, base, low) for docs (g, size, u) and goals (g, due, rate); u: a hash in [0, _BIN ** 2).

    A document takes base copies, and one more if its hash is below low."""
    few = goals.count() <= MAX_SOURCES
    tiered = _meet(docs, goals.select("g", "due"), ["g"], "u", few).withColumn("tier", _tier(F.col("size"), F.col("due")))
    tokens = work.keep(tiered.groupBy("g", "tier").agg(F.sum("size").alias("tokens")), "mix-tiers")
    carry, marks = goals.select("g", F.lit(0.0).alias("carry")), None
    for t in range(len(TIERS) + 1):
        own = tokens.where(F.col("tier") == t).join(goals, "g").join(carry, "g")
        wish = F.greatest(F.col("rate") * F.col("tokens") + F.col("carry"), F.lit(0.0))
        base = F.coalesce(F.least(F.floor(F.try_divide(wish, F.col("tokens"))), F.lit(most)), F.lit(0))
        state = own.select("g", base.alias("base"), (wish - base * F.col("tokens")).alias("extra"), F.lit(0).cast("long").alias("low"))
        done = _threshold(tiered.where(F.col("tier") == t).select("g", "u", "size"), work.keep(state, "mix-tier"), few, work)
        left = done.select("g", F.col("extra").alias("left"))
        missed = F.when(F.col("left").isNull(), F.col("carry")).otherwise(F.col("left") + F.least(F.col("rate") * F.coalesce("tokens", F.lit(0)) + F.col("carry"), F.lit(0.0)))
        carry = work.keep(carry.join(goals.select("g", "rate"), "g").join(tokens.where(F.col("tier") == t).select("g", "tokens"), "g", "left").join(left, "g", "left").select("g", missed.alias("carry")), "mix-carry")
        mark = done.select("g", F.lit(t).alias("tier"), "base", "low")
        marks = mark if marks is None else marks.unionByName(mark)
    return marks


def _hashed(rows: DataFrame, heavy: DataFrame, n: int) -> DataFrame:
    """rows (g, key, at, ...) with u, a hash in [0, _BIN ** 2): of the key, or of key and place for the n heavy keys."""
    u = F.shiftrightunsigned("key", 40)
    if n == 0:
        return rows.withColumn("u", u)
    told = heavy.withColumn("_heavy", F.lit(True))
    if n <= MAX_SOURCES:
        joined = rows.join(F.broadcast(told), ["g", "key"], "left")
    else:
        dealt = told.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn("_salt", F.pmod(F.col("at"), F.lit(SALTS)).cast("int")).join(dealt, ["g", "key", "_salt"], "left").drop("_salt")
    return joined.withColumn("u", F.when(F.col("_heavy"), F.shiftrightunsigned(F.xxhash64("key", "at"), 40)).otherwise(u)).drop("_heavy")


ADDED = ("size", "source_size", "target", "taken", "rate", "copies")


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_COPIES, scope: str | None = None) -> DataFrame:
    """docs with size, source_size and target of the source, taken, rate and copies; columns of these names are replaced."""
    work = Scratch(docs.sparkSession, scope)
    docs = docs.drop(*ADDED)
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))]).withColumn("at", F.monotonically_increasing_id())  # names of other columns may be anything
    own = {c: F.col(f"c{names.index(c)}") for c in ("doc_id", "text", "source")}
    key = F.xxhash64(F.coalesce(own["doc_id"].cast("string"), F.lit("null")), F.coalesce(own["text"], F.lit("")))
    g = F.coalesce(F.concat(F.lit("="), own["source"].cast("string")), F.lit("null"))
    rows = plain.withColumns({"g": g, "size": word_count(own["text"]), "key": key, "source": own["source"].cast("string")})
    sized = work.keep(rows.select("source", "g", "size", "key", "at"), "mix-sizes")
    sizes = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.first("g").alias("g")), weights, most)
    rate = F.least(newton(F.col("source_size").cast("double"), F.col("target")), F.lit(float(most)))
    goals = work.keep(sizes.select("g", "source_size", F.col("target").alias("due"), rate.alias("rate")), "mix-rates")
    repeated = sized.groupBy("g", "key").agg(F.count("*").alias("m"), F.sum("size").alias("tokens")).where("m > 1").join(goals, "g")
    heavy = work.keep(repeated.where(F.col("tokens") > HEAVY * F.col("due")).select("g", "key"), "mix-heavy")
    n = heavy.count()
    marks = work.keep(copies_of(_hashed(sized, heavy, n).select("g", "size", "u"), goals, most, work), "mix-marks")
    # The documents meet only the few rows of goals and marks.
    few = goals.count() <= MAX_SOURCES
    met = _meet(_hashed(rows, heavy, n), goals, ["g"], "u", few).withColumn("tier", _tier(F.col("size"), F.col("due")))
    met = _meet(met, marks, ["g", "tier"], "u", few)
    copies = F.when(F.col("size") == 0, 0).otherwise(F.least(F.col("base") + (F.col("u") < F.col("low")).cast("long"), F.lit(most))).cast("int")
    out = met.withColumn("copies", copies).withColumn("taken", (F.col("size") * F.col("copies")).cast("long"))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "size", "source_size", F.col("due").alias("target"), "taken", "rate", "copies")
