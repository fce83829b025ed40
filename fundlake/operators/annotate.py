"""A table of annotations, and extractors as windows over it (EX-07, EX-08, EX-09).

``annotations`` reads each text once and gives a row for every place that any of
the extractors looks at: (doc_id, start, end, kind, word, value). Words of the
vocabulary are found by one pattern, a tree of their letters, tried at every
place, so words within words and words that overlap are all there. A share is a
percentage, at every digit that one can begin with, and what follows it; a
weight is a word of a region with the percentage after it.

An extractor asks what lies in a window about each of its own words. Windows
become rows among the annotations, a document's rows are put in order once, and
running values from the end of the text back say for each window which
annotation of a class begins after its start first, or ends first. That takes
time in proportion to a document's annotations, whatever the windows hold. Stored
by document (``by="doc_id"``), the table serves all extractors without a shuffle.

Edge cases: a null text has no annotations; documents without any, or without a
result, are not in an extractor's result. Ids are taken to be unique; rows that
share one are read as one document. Null ids are one document too.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlake.functions import numbers as N
from fundlake.functions.text import let, quote, running
from fundlake.operators.extract import ACTIVE_WORDS, DENIALS, EQUITY, NO_ACTIVE, ONLY_PASSIVE, PARTLY_PASSIVE, PASSIVE_WORDS, PCT, REGION_FOCUS, REGION_LABELS, REGIONS, STYLE_FOCUS, WEIGHT_FOCUS, style_of

#: Characters between a region's word and its percentage, about and after the words that windows are put at.
NEAR, REGION_SPAN, STYLE_SPAN, WEIGHT_SPAN = 30, 300, 200, 1000
VOCABULARY = tuple(dict.fromkeys((*REGION_FOCUS, *WEIGHT_FOCUS, *STYLE_FOCUS, *EQUITY, *(w for _, ws in REGION_LABELS for w in ws), *ACTIVE_WORDS, *PASSIVE_WORDS, *DENIALS, *PARTLY_PASSIVE, *NO_ACTIVE, *ONLY_PASSIVE)))
_MARK = "struct<start:int,end:int,kind:string,word:string,value:double>"


def tree(words: Iterable[str]) -> str:
    """A pattern of the longest of some words, without trying one after the other."""
    heads: dict[str, set[str]] = {}
    ends = False
    for w in words:
        if w:
            heads.setdefault(w[0], set()).add(w[1:])
        else:
            ends = True
    if not heads:
        return ""
    parts = [quote(c) + tree(rest) for c, rest in sorted(heads.items())]
    return f"(?:{'|'.join(parts)})" + ("?" if ends else "")


def guard(words: Sequence[str]) -> str:
    """A pattern that stands ahead of any of some words, and of little else: their first letters, by place."""
    size = min(map(len, words))
    return "(?=" + "".join("[" + "".join(quote(x) for x in sorted({w[i] for w in words})) + "]" for i in range(size)) + ")"


def places(c: Column, pattern: str, ahead_of: str = "") -> Column:
    """(start, found) of every place at which a pattern matches, also within a match; a pattern that matches the empty text is not for this.

    ahead_of: a cheap pattern that holds wherever the other matches, tried first."""
    ahead = f"{ahead_of}(?=({pattern}))"
    found = F.regexp_extract_all(c, F.lit(ahead), F.lit(1))

    def located(found: Column) -> Column:
        sizes = let(F.split(c, ahead, -1), lambda pieces: F.transform(pieces, lambda p: F.length(p)))
        # Nothing is cut off before a match at the very start.
        starts = let(let(sizes, running), lambda ends: F.when(F.size(ends) == F.size(found), F.concat(F.array(F.lit(0)), ends)).otherwise(ends))
        return F.zip_with(found, F.slice(starts, 1, F.size(found)), lambda f, s: F.struct(s.alias("start"), f.alias("found")))

    none = F.array().cast("array<struct<start:int,found:string>>")
    return F.coalesce(let(found, lambda f: F.when(F.size(f) > 0, located(f)).otherwise(none)), none)


def _within(words: Sequence[str], found: Column) -> Column:
    """The words that a found word begins with, itself among them."""
    nested = {w: [p for p in words if w.startswith(p)] for w in words}
    longer = {w: ps for w, ps in nested.items() if len(ps) > 1}
    alone = F.array(found)
    if not longer:
        return alone
    pairs = [x for w, ps in longer.items() for x in (F.lit(w), F.array(*map(F.lit, ps)))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), found), alone)


def _mark(start: Column, end: Column, kind: str, word: Column, value: Column | None = None) -> Column:
    empty = F.lit(None).cast("double")
    return F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), word.alias("word"), (empty if value is None else value).alias("value"))


def _words(t: Column) -> Column:
    each = lambda p: F.transform(_within(VOCABULARY, p["found"]), lambda w: _mark(p["start"], p["start"] + F.length(w), "word", w))
    return F.flatten(F.transform(places(t, tree(VOCABULARY), guard(VOCABULARY)), each))


def _shares(t: Column) -> Column:
    """A mark for each region's word that follows a percentage, from that to the word's end."""
    longest = max(map(len, REGIONS))

    def each(p: Column) -> Column:
        size = F.length(F.regexp_extract(p["found"], f"^{PCT}", 0))

        def after(size: Column) -> Column:
            tail, value = F.substring(p["found"], size + 1, NEAR + longest), N.comma_decimal(F.regexp_extract(p["found"], f"^{PCT}", 1))
            at = lambda w: F.instr(tail, F.lit(w))
            return F.array(*[F.when((at(w) > 0) & (at(w) <= NEAR + 1), _mark(p["start"], p["start"] + size + at(w) - 1 + len(w), "share", F.lit(w), value)) for w in REGIONS])

        return F.filter(let(size, after), lambda m: m.isNotNull())

    return F.flatten(F.transform(places(t, f"{PCT.replace('(', '(?:', 1)}.{{0,{NEAR + longest}}}"), each))


def _weights(t: Column) -> Column:
    """A mark for each region's word that a percentage follows, to the percentage's end."""
    pattern = f"({tree(REGIONS)})(.{{0,{NEAR}}}?){PCT}"

    def each(p: Column) -> Column:
        part = lambda i: F.regexp_extract(p["found"], f"^{pattern}", i)
        gap = F.length(part(1)) + F.length(part(2))
        near = F.filter(_within(tuple(REGIONS), part(1)), lambda w: gap - F.length(w) <= NEAR)
        return F.transform(near, lambda w: _mark(p["start"], p["start"] + F.length(p["found"]), "weight", w, N.comma_decimal(part(3))))

    return F.flatten(F.transform(places(t, pattern.replace("(", "(?:").replace("(?:?:", "(?:"), guard(list(REGIONS))), each))


def annotations(docs: DataFrame, by: str | None = None) -> DataFrame:
    """(doc_id, start, end, kind, word, value) of lower-cased texts, in code points, end exclusive; by: the column that the rows are dealt by."""
    t = docs.select("doc_id", F.lower("text").alias("t")).where("t IS NOT NULL")
    none = F.array().cast(f"array<{_MARK}>")
    shares = F.when(F.col("t").contains("%"), F.concat(_shares(F.col("t")).cast(f"array<{_MARK}>"), _weights(F.col("t")).cast(f"array<{_MARK}>"))).otherwise(none)
    marks = F.concat(_words(F.col("t")).cast(f"array<{_MARK}>"), shares)
    rows = t.select("doc_id", F.explode(marks).alias("m")).select("doc_id", "m.*")
    return rows if by is None else rows.repartition(by)


def _probed(marks: DataFrame, words: Sequence[str], before: int, after: int) -> DataFrame:
    """Marks with a second row for a window about each of the words: at is where a row stands, probe a window's word, until its end."""
    row = lambda at, probe, until: F.struct(at.alias("at"), probe.cast("string").alias("probe"), until.cast("int").alias("until"))
    window = F.when((F.col("kind") == "word") & F.col("word").isin(*words), row(F.greatest(F.col("start") - before, F.lit(0)), F.col("word"), F.col("end") + after))
    both = F.filter(F.array(row(F.col("start"), F.lit(None), F.lit(None)), window), lambda x: x.isNotNull())
    return marks.withColumn("_row", F.explode(both)).select(*marks.columns, "_row.*")  # rows stay where their document is


def _back() -> Window:
    """From the end of a document to a row; a window's row comes after the marks at its place."""
    return Window.partitionBy("doc_id").orderBy(F.desc("at"), F.col("probe").isNotNull()).rangeBetween(Window.unboundedPreceding, Window.currentRow)


def _held(marks: DataFrame, focus: Sequence[str], span: int, classes: dict[str, Sequence[str]]) -> DataFrame:
    """(doc_id, probe, start, one boolean for each class): whether a window about a focus word has a word of the class."""
    own = marks.where("kind = 'word'")
    first = {f"_{i}": F.min(F.when(F.col("probe").isNull() & F.col("word").isin(*ws), F.col("end"))).over(_back()) for i, ws in enumerate(classes.values())}
    held = _probed(own, focus, span, span).withColumns(first).where("probe IS NOT NULL")
    return held.select("doc_id", "probe", "start", *[F.coalesce(F.col(f"_{i}") <= F.col("until"), F.lit(False)).alias(c) for i, c in enumerate(classes)])


def _order(c: str, values: Sequence[str]) -> Column:
    return F.array_position(F.array(*map(F.lit, values)), F.col(c))


def regions_named(marks: DataFrame) -> DataFrame:
    """EX-07: (doc_id, regions), as ``extract.regions_named`` gives them."""
    labels = [label for label, _ in REGION_LABELS]
    held = _held(marks, REGION_FOCUS, REGION_SPAN, dict(REGION_LABELS))
    each = held.select("doc_id", _order("probe", REGION_FOCUS).alias("p"), "start", F.explode(F.filter(F.array(*[F.when(F.col(label), F.struct(F.lit(i).alias("i"), F.lit(label).alias("label"))) for i, label in enumerate(labels)]), lambda x: x.isNotNull())).alias("x"))
    counted = each.groupBy("doc_id", F.col("x.label").alias("label")).agg((-F.count("*")).alias("n"), F.min(F.struct("p", "start", "x.i")).alias("first"))
    top = counted.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "first", "label"))), lambda x: x["label"]).alias("top"))
    has = lambda v: F.array_contains("top", v)
    top = top.withColumn("top", F.when(has("North America") & has("Europe") & ~has("Global"), F.concat(F.array(F.lit("Global")), F.col("top"))).otherwise(F.col("top")))
    top = top.withColumn("top", F.when(has("Global") & has("Netherlands") & (F.size("top") > 2), F.array_remove("top", "Netherlands")).otherwise(F.col("top")))
    return top.select("doc_id", F.array_join(F.slice("top", 1, 3), ", ").alias("regions"))


def region_weights(marks: DataFrame) -> DataFrame:
    """EX-08: (doc_id, weights), an array of (region, weight), as ``extract.region_weights`` gives them."""
    words = list(REGIONS)
    probed = _probed(marks.where((F.col("kind") != "word") | F.col("word").isin(*WEIGHT_FOCUS)), WEIGHT_FOCUS, 0, WEIGHT_SPAN)
    # Of a region's word the first mark in a window; if that one's weight is out of bounds there is no second.
    firsts = [F.last(F.when(F.col("probe").isNull() & (F.col("kind") == kind) & (F.col("word") == w), F.struct("end", "value")), ignorenulls=True).over(_back().rowsBetween(Window.unboundedPreceding, Window.currentRow)) for kind in ("weight", "share") for w in words]
    seen = probed.withColumn("x", F.array(*firsts)).where("probe IS NOT NULL").select("doc_id", _order("probe", WEIGHT_FOCUS).alias("p"), "start", "until", F.posexplode("x").alias("i", "x"))
    good = seen.where((F.col("x.end") <= F.col("until")) & (F.col("x.value") > 0) & (F.col("x.value") <= 100))
    region = F.element_at(F.array(*[F.lit(REGIONS[w]) for w in words]), (F.col("i") % len(words) + 1).cast("int"))
    order = F.struct((F.col("i") >= len(words)).alias("back"), "p", "start", "i")
    best = good.groupBy("doc_id", region.alias("region")).agg(F.min(order).alias("order"), F.min_by("x.value", order).alias("weight"))
    return best.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("order", "region", "weight"))), lambda x: F.struct(x["region"].alias("region"), x["weight"].alias("weight"))).alias("weights"))


def management_style(marks: DataFrame) -> DataFrame:
    """EX-09: (doc_id, style), as ``extract.management_style`` gives it."""
    classes = {"equity": EQUITY, "active": ACTIVE_WORDS, "passive": PASSIVE_WORDS, "denied": DENIALS, "partly": PARTLY_PASSIVE}
    held = _held(marks, STYLE_FOCUS, STYLE_SPAN, classes).where("equity")
    near = held.groupBy("doc_id").agg((2 * F.count_if(F.col("active") & F.col("denied")) + F.count_if("passive")).alias("passive"), (F.count_if(F.col("active") & ~F.col("denied")) + F.count_if(F.col("passive") & F.col("partly"))).alias("active"))
    said = lambda words: F.when(F.max(F.col("word").isin(*words)), 5).otherwise(0)
    strong = marks.where("kind = 'word'").groupBy("doc_id").agg((said(NO_ACTIVE) + said(ONLY_PASSIVE)).alias("strong"))
    score = lambda c: F.coalesce(F.col(c), F.lit(0))
    scores = strong.join(near, "doc_id", "left").select("doc_id", (score("passive") + F.col("strong")).alias("passive"), score("active").alias("active"))
    return scores.select("doc_id", style_of(F.col("passive"), F.col("active")).alias("style")).where("style IS NOT NULL")
