"""How alike two names are: the matching-blocks ratio as a Column expression, and bounds of it that can be keys.

The ratio of texts of n and m characters is 2 * M / (n + m). M is the total
length of the matching blocks: the longest common run (of several the first in
the left text, then the first in the right), and in turn those left and right of
it. Two texts without characters have ratio 1.

Runs are found once for a pair: places with equal characters, put together along
the diagonals. A segment's longest run is then the longest of those, clipped to
the segment, so a step looks at a few dozen runs and not at characters. Segments
are taken off a list until it is empty.

No matching can have more characters than the texts share, each letter counted
as often as both have it. With ``tokens`` (a letter and the how-manieth of its
kind it is) that is the overlap of two sets, so a ratio above r needs an overlap
above r / 2 * (n + m): ``needed``. Tokens come rarest kinds first, so texts with
that much overlap share one of their first n - needed + 1 (of m - needed + 1).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundlake.functions.text import let

#: Letters from frequent to rare; only the speed depends on it.
FREQUENT = "e naitrodslghvkmubpwjczf"


def _runs(x: Column, y: Column) -> Column:
    """Runs (n, i, j) of two arrays of characters: x[i + k] = y[j + k] for k < n, as long as can be."""
    zero = F.lit(0)
    beside = lambda i: F.filter(F.sequence(zero, F.size(y) - 1), lambda j: F.get(y, j) == F.get(x, i))
    same = F.flatten(F.transform(F.sequence(zero, F.size(x) - 1), lambda i: F.transform(beside(i), lambda j: F.struct((j - i).alias("d"), i.alias("i")))))

    def joined(at: Column) -> Column:
        apart = lambda p, other, step: F.coalesce((other["d"] != p["d"]) | (other["i"] != p["i"] + step), F.lit(True))
        firsts = F.filter(at, lambda p, k: apart(p, F.get(at, k - 1), -1))
        lasts = F.filter(at, lambda p, k: apart(p, F.get(at, k + 1), 1))
        return F.zip_with(firsts, lasts, lambda s, e: F.struct((e["i"] - s["i"] + 1).alias("n"), s["i"].alias("i"), (s["i"] + s["d"]).alias("j")))

    return let(F.array_sort(same), joined)


def _segment(al: Column, ah: Column, bl: Column, bh: Column) -> Column:
    return F.struct(al.alias("al"), ah.alias("ah"), bl.alias("bl"), bh.alias("bh"))


def _longest(runs: Column, s: Column) -> Column:
    """The longest run in a segment, as (n, -i, -j): of several the first by i, then by j; null if there is none."""

    def clipped(r: Column) -> Column:
        skip = F.greatest(F.lit(0), s["al"] - r["i"], s["bl"] - r["j"])
        return F.struct((F.least(r["n"], s["ah"] - r["i"], s["bh"] - r["j"]) - skip).alias("n"), (-(r["i"] + skip)).alias("i"), (-(r["j"] + skip)).alias("j"))

    return F.array_max(F.filter(F.transform(runs, clipped), lambda r: r["n"] > 0))


def _matched(runs: Column, n: Column, m: Column) -> Column:
    """Total length of the matching blocks; each step takes a segment off the list."""
    state = lambda todo, total: F.struct(todo.alias("todo"), total.alias("sum"))
    zero = F.lit(0)

    def step(a: Column, _: Column) -> Column:
        s, rest = F.get(a["todo"], 0), F.slice(a["todo"], 2, F.greatest(F.size(a["todo"]), F.lit(1)))

        def split(b: Column) -> Column:
            halves = F.array(_segment(s["al"], -b["i"], s["bl"], -b["j"]), _segment(b["n"] - b["i"], s["ah"], b["n"] - b["j"], s["bh"]))
            more = F.filter(halves, lambda x: (x["al"] < x["ah"]) & (x["bl"] < x["bh"]))
            return F.when(b.isNull(), state(rest, a["sum"])).otherwise(state(F.concat(rest, more), a["sum"] + b["n"]))

        return F.when(F.size(a["todo"]) == 0, a).otherwise(let(_longest(runs, s), split))

    start = state(F.array(_segment(zero, n, zero, m)), zero)
    return F.aggregate(F.sequence(F.lit(1), 2 * F.least(n, m)), start, step, lambda a: a["sum"])  # blocks and segments without one


def ratio(a: Column, b: Column) -> Column:
    """UDF-03, STR-17: the matching-blocks ratio of two lower-cased texts (not an edit distance); null for null."""
    chars = lambda c: F.when(F.length(c) > 0, F.split(F.lower(c), "")).otherwise(F.array().cast("array<string>"))

    def of(p: Column) -> Column:
        n, m = F.size(p["x"]), F.size(p["y"])
        blocks = let(_runs(p["x"], p["y"]), lambda runs: _matched(runs, n, m))
        return F.when(n + m == 0, 1.0).when((n == 0) | (m == 0), 0.0).otherwise(2.0 * blocks / (n + m))

    return F.when(a.isNotNull() & b.isNotNull(), let(F.struct(chars(a).alias("x"), chars(b).alias("y")), of))


def tokens(c: Column) -> Column:
    """Each character of a text with the how-manieth of its kind it is; rare kinds first, in an order that all texts share."""
    times = lambda x: F.length(c) - F.length(F.replace(c, x, F.lit("")))
    rank = lambda x: F.instr(F.lit(FREQUENT), x)
    one = lambda x: F.transform(F.sequence(F.lit(1), times(x)), lambda k: F.struct((-k).alias("k"), F.when(rank(x) == 0, -len(FREQUENT) - 1).otherwise(-rank(x)).alias("f"), x.alias("x")))
    each = F.flatten(F.transform(F.array_distinct(F.split(c, "")), one))
    return F.when(F.length(c) > 0, F.transform(F.array_sort(each), lambda t: F.concat(t["x"], (-t["k"]).cast("string")))).otherwise(F.array().cast("array<string>"))


def needed(n: Column, m: Column, least: float) -> Column:
    """Tokens that texts of n and m characters share at least, if their ratio is above least."""
    return (F.floor(F.lit(least / 2) * (n + m) - 1e-9) + 1).cast("int")
