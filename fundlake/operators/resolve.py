"""Which fund does this name mean: exact, by containment, by alias, by likeness (JN-14 to JN-27).

All rules meet by keys (``contain``, ``alike``): none tests every pair. Names are
made distinct and cleaned once before they meet. Tables of names are larger than
their files, so joins of them are told to merge, not to broadcast. Of several hits the smallest id
counts; a rule gives (name, id, n), n being the number of rows that it hit.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.functions.names import clean_name, packed_name
from fundlake.operators.alike import alike
from fundlake.operators.contain import holding

#: Fixed values: (word in the wanted name, words in the fund's name).
ALIASES = (("pme", ("pme",)), ("metalektro", ("pme",)), ("pmt", ("pmt",)), ("metaal en techniek", ("pmt",)), ("bouw", ("bouw", "bpf")))

#: (names, funds) to hits: names has name, funds has id and fund, hits have name, id and n.
Rule = Callable[[DataFrame, DataFrame], DataFrame]
Clean = Callable[[Column], Column]


def _texts(names: DataFrame, funds: DataFrame, clean: Clean, own: Clean) -> tuple[DataFrame, DataFrame]:
    """(name, a) and, once for each text, (b, id, n): its smallest id and its rows."""
    once = lambda c: F.explode(F.array(c))  # noqa: E731  # else each filter on the text cleans it anew
    b = funds.select("id", once(own(F.col("fund"))).alias("b")).where("b IS NOT NULL").groupBy("b").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    return names.select("name", once(clean(F.col("name"))).alias("a")).where("a IS NOT NULL"), b


def _hits(a: DataFrame, pairs: DataFrame, b: DataFrame) -> DataFrame:
    return a.join(pairs.hint("merge"), "a").join(b.hint("merge"), "b").groupBy("name").agg(F.min("id").alias("id"), F.sum("n").alias("n"))


def equal(clean: Clean) -> Rule:
    """The same text."""

    def rule(names: DataFrame, funds: DataFrame) -> DataFrame:
        a, b = _texts(names, funds, clean, clean)
        return a.join(b.hint("merge"), F.col("a") == F.col("b")).select("name", "id", "n")

    return rule


def in_fund(clean: Clean, own: Clean, least: int = 0) -> Rule:
    """The name, of at least so many characters, is part of the fund's."""

    def rule(names: DataFrame, funds: DataFrame) -> DataFrame:
        a, b = _texts(names, funds, clean, own)
        return _hits(a, _pairs(a, b, least, None), b)

    return rule


def in_name(clean: Clean, own: Clean, least: int = 0) -> Rule:
    """The fund's name, of at least so many characters, is part of the name."""

    def rule(names: DataFrame, funds: DataFrame) -> DataFrame:
        a, b = _texts(names, funds, clean, own)
        return _hits(a, _pairs(a, b, None, least), b)

    return rule


def either(clean: Clean, least: int, own_least: int | None = None, same: bool = True) -> Rule:
    """JN-14: the one is part of the other, or (same) equal to it; a part has at least so many characters."""

    def rule(names: DataFrame, funds: DataFrame) -> DataFrame:
        a, b = _texts(names, funds, clean, clean)
        return _hits(a, _pairs(a, b, least, least if own_least is None else own_least, same), b)

    return rule


def _pairs(a: DataFrame, b: DataFrame, least: int | None, own_least: int | None, same: bool = False) -> DataFrame:
    """(a, b) of texts of which b holds a, of so many characters at least, or a holds b; None: not looked for."""
    left, right, out = a.select("a").distinct(), b.select("b"), []
    if least is not None:
        out.append(holding(left.where(F.length("a") >= least).select(F.col("a").alias("part")), right.where(F.length("b") >= least).select(F.col("b").alias("whole"))).select(F.col("part").alias("a"), F.col("whole").alias("b")))
    if own_least is not None:
        out.append(holding(right.where(F.length("b") >= own_least).select(F.col("b").alias("part")), left.where(F.length("a") >= own_least).select(F.col("a").alias("whole"))).select(F.col("whole").alias("a"), F.col("part").alias("b")))
    if same:
        out.append(left.join(right.hint("merge"), F.col("a") == F.col("b")))
    return out[0] if len(out) == 1 else reduce(DataFrame.union, out).distinct()


def text_pairs(a: DataFrame, b: DataFrame, least: int) -> DataFrame:
    """(a, b) of all pairs of equal texts, or of which the one, of at least so many characters, is part of the other; a: (a), b: (b)."""
    return _pairs(a.where("a IS NOT NULL"), b.select("b").where("b IS NOT NULL").distinct(), least, least, same=True)


def all_pairs(names: DataFrame, funds: DataFrame, clean: Clean, least: int | None, own_least: int | None, same: bool = False) -> DataFrame:
    """(name, id) of every pair of rows whose names hold each other, as in ``_pairs``; funds: (id, fund)."""
    a, b = names.select("name", clean(F.col("name")).alias("a")), funds.select("id", clean(F.col("fund")).alias("b"))
    return a.join(_pairs(a, b.select("b").distinct(), least, own_least, same), "a").join(b, "b").select("name", "id")


def contained_pairs(wanted: DataFrame, funds: DataFrame, clean: Clean, least: int) -> DataFrame:
    """(name, id) of all pairs of equal cleaned names, or of which the one, longer than least, is part of the other."""
    return all_pairs(wanted, funds, clean, least + 1, least + 1, same=True).distinct()


def match_short(wanted: DataFrame, funds: DataFrame) -> DataFrame:
    """JN-17, JN-22: (name, id) of all pairs of a name of more than three characters and a fund's, of which one holds the other."""
    names = wanted.select("name").distinct().where(F.length(F.lower("name")) > 3)
    return all_pairs(names, funds.select("id", F.col("name").alias("fund")), F.lower, 0, 0)


def alias_pairs(wanted: DataFrame, funds: DataFrame) -> DataFrame:
    """JN-15: hits by alias: names with an alias' word and the smallest fund with its own words, met by the alias' number."""
    flagged = lambda c, k: F.filter(F.array(*[F.when(reduce(lambda x, y: x & y, [F.lower(c).contains(w) for w in ((words[0],) if k == 0 else words[1])]), F.lit(i)) for i, words in enumerate(ALIASES)]), lambda x: x.isNotNull())
    names = wanted.select("name", F.explode(flagged(F.col("name"), 0)).alias("alias"))
    own = funds.select("id", F.explode(flagged(F.col("fund"), 1)).alias("alias")).groupBy("alias").agg(F.min("id").alias("id"))
    return names.join(own, "alias").groupBy("name").agg(F.min("id").alias("id"), F.count("*").alias("n"))


def first_match(wanted: DataFrame, funds: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(name, id): each wanted name with the smallest id of the first rule that has any; null if none has."""
    names = wanted.select("name").distinct()
    f = funds.select("id", F.col("name").alias("fund"))
    hits = reduce(DataFrame.union, [rule(names, f).select("name", "id", F.lit(i).alias("rule")) for i, rule in enumerate(rules)])
    return names.join(hits.groupBy("name").agg(F.min_by("id", F.struct("rule", "id")).alias("id")).hint("merge"), "name", "left")


def match_regulator(wanted: DataFrame, funds: DataFrame) -> DataFrame:
    """JN-14, then JN-15."""
    return first_match(wanted, funds, [either(clean_name, 6), alias_pairs])


def match_planning(wanted: DataFrame, funds: DataFrame) -> DataFrame:
    """JN-16: the fund's packed name in the line; else the line's first word, longer than three, in the fund's name."""
    packed = lambda c: packed_name(c, closed=False)
    core = lambda c: F.replace(F.lower(F.get(F.split(c, r"\s+"), 0)), F.lit("kring"), F.lit(""))
    return first_match(wanted, funds, [in_name(packed, packed, 5), in_fund(core, F.lower, 4)])


def match_like(wanted: DataFrame, funds: DataFrame) -> DataFrame:
    """JN-23: the fund whose name has the words, in any case."""
    return first_match(wanted, funds, [in_fund(F.lower, F.lower)])


def match_unique(wanted: DataFrame, funds: DataFrame) -> DataFrame:
    """JN-24: exact; contained in one fund's name only; equal but for case; the part before a parenthesis or between slashes in one only."""

    def only(rule: Rule) -> Rule:
        return lambda names, f: rule(names, f).where("n = 1")

    def slashes(names: DataFrame, f: DataFrame) -> DataFrame:
        parts = names.where(F.col("name").contains("/")).select("name", F.posexplode(F.split("name", "/")).alias("pos", "part")).select("name", "pos", F.trim("part").alias("part"))
        found = only(in_fund(F.lower, F.lower))(parts.select(F.col("part").alias("name")).distinct(), f).withColumnRenamed("name", "part")
        return parts.join(found.hint("merge"), "part").groupBy("name").agg(F.min_by("id", "pos").alias("id"))

    before = lambda c: F.lower(F.when(c.contains("("), F.rtrim(F.split_part(c, F.lit("("), F.lit(1)))))
    return first_match(wanted, funds, [equal(lambda c: c), only(in_fund(F.lower, F.lower, 1)), equal(F.lower), only(in_fund(before, F.lower, 1)), slashes])


def match_fuzzy(wanted: DataFrame, funds: DataFrame, least: float = 0.65) -> DataFrame:
    """JN-25: equal but for case; contained; containing; else the most alike above least, the smaller id if equal. Only the last has a score."""
    sure = first_match(wanted, funds, [equal(F.lower), in_fund(F.lower, F.lower), in_name(F.lower, F.lower)])
    left = sure.where("id IS NULL AND name IS NOT NULL").select("name", F.lower("name").alias("a"))
    _, right = _texts(wanted.select("name"), funds.select("id", F.col("name").alias("fund")), F.lower, F.lower)
    scored = alike(left.select("a"), right.select("b"), least).join(right, "b")
    near = scored.groupBy("a").agg(F.max(F.struct("score", (-F.col("id")).alias("id"))).alias("x")).select("a", (-F.col("x.id")).alias("near"), "x.score")
    return sure.join(left.join(near, "a").select("name", "near", "score"), "name", "left").select("name", F.coalesce("id", "near").alias("id"), "score")


def unmatched(wanted: DataFrame, funds: DataFrame) -> DataFrame:
    """JN-19: names that no fund with a ratio other than 0 contains or is contained in."""
    known = funds.where(F.col("ratio").isNotNull() & (F.col("ratio") != 0)).select("id", F.col("name").alias("fund"))
    return wanted.join(either(F.lower, 0)(wanted.select("name").distinct(), known).select("name"), "name", "left_anti")


def match_file(funds: DataFrame, files: DataFrame) -> DataFrame:
    """JN-27: (id, path): the first path that has all words over two letters of a name, else any over four.

    Words meet the paths by ``holding``. All words: by the one that the fewest paths have, and the others are looked for there. Any: each word's first path."""
    words = F.filter(F.split(F.lower("name"), r"[^\p{L}\p{N}]+"), lambda w: F.length(w) > 2)
    f = funds.select("name").distinct().select("name", F.array_distinct(words).alias("words")).where(F.size("words") > 0)
    each = f.select("name", "words", F.explode("words").alias("word"))
    low = files.select("path", F.lower("path").alias("low")).distinct()
    met = holding(each.select(F.col("word").alias("part")), low.select(F.col("low").alias("whole")))
    at = met.select(F.col("part").alias("word"), F.col("whole").alias("low")).join(low.hint("merge"), "low")
    per = at.groupBy("word").agg(F.count("*").alias("paths"), F.min("path").alias("path"))
    known = each.join(per.hint("merge"), "word", "left")
    rarest = known.groupBy("name", "words").agg(F.min_by("word", F.struct(F.coalesce("paths", F.lit(0)), "word")).alias("word"))
    full = rarest.join(at.hint("merge"), "word").where(F.forall("words", lambda w: F.col("low").contains(w))).groupBy("name").agg(F.min("path").alias("path"))
    some = known.where(F.length("word") > 4).groupBy("name").agg(F.min("path").alias("any")).where("any IS NOT NULL")
    best = some.join(full.hint("merge"), "name", "full").select("name", F.coalesce("path", "any").alias("path"))
    return funds.select("id", "name").join(best.hint("merge"), "name").select("id", "path")


def first_file(funds: DataFrame, files: DataFrame) -> DataFrame:
    """JN-13: the first path, by name, that begins with the fund's id and an underscore."""
    key = F.regexp_extract("path", r"([^/]*)$", 1)
    return files.withColumn("id", F.regexp_extract(key, r"^(\d+)_", 1).try_cast("long")).join(funds.select("id"), "id").groupBy("id").agg(F.min("path").alias("path"))
