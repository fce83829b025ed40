"""Web pages: links, table rows, blocks and visible text (SRC-18 to SRC-22) by an index of elements, in SQL functions.

A page is cut into markup and the texts between: one pattern knows comments,
scripts and styles with what they hold, declarations and tags whose attributes
may hold ">" in quotes. The tags asked for open and close elements by a list of
the open ones: an end tag closes the innermost element of its name and all that
were opened in it; one that nothing is open for is passed over; what is never
closed goes on to the end of the page. An element is the places of its tags, and
its text the texts between them, without those in noscript and template. Tags
without contents (br, img, ...) open nothing unless asked for.

Character references in texts and attributes are resolved by the HTML names (an
ampersand that begins none stays). Of an attribute given twice the last counts.
"""

from __future__ import annotations

import html as _names
import json
from collections.abc import Sequence
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.functions.text import let, squeeze, strip

#: Markup: comments, scripts and styles, declarations and instructions, tags.
_MARKUP = r"""(?is)<!--.*?(?:--!?>|\z)|<(script|style)\b(?:[^>"']++|"[^"]*+"|'[^']*+')*+>.*?(?:</\1[^>]*+>|\z)|<[!?][^>]*+>|</?+[a-z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
_NAME = r"(?is)^</?([a-z][^\s/>]*)"
_ATTRIBUTE = r"""(?is)([^\s/>="'][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*)))?"""
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]{1,31};?)"
_SILENT = ("noscript", "template")


def _character(s: Column) -> Column:
    """The character of a numeric reference without its ampersand; as browsers do for numbers that mean none."""
    digits = F.rtrim(F.regexp_replace(s, "^#[xX]?", ""), F.lit(";"))
    n = F.when(s.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(F.substring(digits, 1, 10)).try_cast("long")
    # 128 to 159 are meant as in the Windows code page.
    low = {i: _names.unescape(f"&#{i};") for i in (0, 13, *range(0x80, 0xA0))}
    coded = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    known = F.try_element_at(F.create_map(*[F.lit(x) for pair in low.items() for x in (int(pair[0]), pair[1])]), n.cast("int"))
    unknown = n.isNull() | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF)
    control = n.between(1, 8) | n.between(14, 31) | n.isin(11, 127) | n.between(0xFDD0, 0xFDEF) | ((n % 0x10000) >= 0xFFFE)
    return F.when(unknown, "\ufffd").when(n.isin(0, 13) | n.between(0x80, 0x9F), known).when(control, "").otherwise(coded)


def unescape(c: Column) -> Column:
    """A text with its character references resolved."""
    names = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")

    def named(s: Column) -> Column:
        # Old names count without their semicolon too, and then what follows is text.
        shorter = F.filter(F.transform(F.sequence(F.length(s), F.lit(2), F.lit(-1)), lambda n: F.substring(s, 1, n)), lambda x: F.try_element_at(names, x).isNotNull())
        return let(F.get(shorter, 0), lambda x: F.when(x.isNull(), F.concat(F.lit("&"), s)).otherwise(F.concat(F.try_element_at(names, x), F.substring(s, F.length(x) + 1, 64))))

    def one(r: Column) -> Column:
        usual = F.when(r == "&amp;", "&").when(r == "&lt;", "<").when(r == "&gt;", ">").when(r == "&quot;", '"').when(r == "&nbsp;", "\u00a0")
        return usual.otherwise(let(F.substring(r, 2, 64), lambda s: F.when(s.startswith("#"), _character(s)).otherwise(named(s))))

    found, between = F.regexp_extract_all(c, F.lit(_REFERENCE), F.lit(0)), F.split(c, _REFERENCE, -1)
    joined = F.array_join(F.transform(F.arrays_zip(between.alias("t"), F.concat(F.transform(found, one), F.array(F.lit(""))).alias("r")), lambda x: F.concat(x["t"], x["r"])), "")
    return F.when(c.contains("&"), joined).otherwise(c)


def attribute(tag: Column, name: str) -> Column:
    """The value of a tag's attribute: empty if it has none, null if there is no such attribute."""
    body = F.regexp_replace(tag, r"(?is)^<[a-z][^\s/>]*", "")
    at = lambda i: F.regexp_extract_all(body, F.lit(_ATTRIBUTE), F.lit(i))
    pairs = F.arrays_zip(at(1).alias("n"), at(2).alias("a"), at(3).alias("b"), at(4).alias("c"))
    return let(F.try_element_at(F.filter(pairs, lambda x: F.lower(x["n"]) == name), F.lit(-1)), lambda x: F.when(x.isNotNull(), unescape(F.concat(x["a"], x["b"], x["c"]))))


def _parts(c: Column) -> Column:
    """A page's markup m, the names of its tags (n; with a slash if they end an element; empty for other markup) and the texts t before, between and after, silent ones empty."""
    tag = lambda m: F.concat(F.when(m.startswith("</"), "/").otherwise(""), F.lower(F.regexp_extract(m, _NAME, 1)))

    def named(m: Column) -> Column:
        return let(F.transform(m, lambda x: F.when(x.rlike("(?is)^<(?:script|style)\\b"), "").otherwise(tag(x))), lambda n: F.struct(m.alias("m"), n.alias("n"), shown(m, n).alias("t")))

    def shown(m: Column, n: Column) -> Column:
        texts = F.split(c, _MARKUP, -1)
        quiet = let(_elements(n, m, _SILENT), lambda held: F.transform(texts, lambda t, i: F.when(F.exists(held, lambda e: (e["from"] < i) & (i <= e["to"])), "").otherwise(t)))
        return F.when(F.exists(n, lambda x: x.isin(*_SILENT)), quiet).otherwise(texts)

    return let(F.regexp_extract_all(c, F.lit(_MARKUP), F.lit(0)), named)


_OPEN, _DONE = "array<struct<n:int,tag:string,from:int>>", "array<struct<n:int,tag:string,from:int,to:int>>"


def _elements(n: Column, m: Column, tags: Sequence[str]) -> Column:
    """Elements of some tags by the names of a page's markup: (n: how many were opened before, tag, from, to: places in the markup, from 0)."""
    wanted = [*tags, *[f"/{t}" for t in tags]]
    events = F.filter(F.transform(n, lambda x, i: F.struct(x.alias("x"), i.alias("i"), F.get(m, i).endswith("/>").alias("own"))), lambda e: e["x"].isin(*wanted))
    state = lambda n, stack, done: F.struct(n.alias("n"), stack.alias("open"), done.alias("done"))
    ended = lambda items, i: F.transform(items, lambda s: F.struct(s["n"].alias("n"), s["tag"].alias("tag"), s["from"].alias("from"), i.alias("to")))
    size = lambda a: F.size(a["open"])

    def begin(a: Column, e: Column) -> Column:
        item = F.array(F.struct(a["n"].alias("n"), e["x"].alias("tag"), e["i"].alias("from")))
        return F.when(e["own"], state(a["n"] + 1, a["open"], F.concat(a["done"], ended(item, e["i"])))).otherwise(state(a["n"] + 1, F.concat(item, a["open"]), a["done"]))

    def end(a: Column, e: Column) -> Column:
        at = F.array_position(F.transform(a["open"], lambda s: s["tag"]), F.substring(e["x"], 2, 64)).cast("int")  # the innermost is first
        closed = state(a["n"], F.slice(a["open"], at + 1, F.greatest(size(a), F.lit(1))), F.concat(a["done"], ended(F.slice(a["open"], 1, at), e["i"])))
        return F.when(at > 0, closed).otherwise(a)

    start = state(F.lit(0), F.array().cast(_OPEN), F.array().cast(_DONE))
    whole = F.size(n)
    all_ = F.aggregate(events, start, lambda a, e: F.when(e["x"].startswith("/"), end(a, e)).otherwise(begin(a, e)), lambda a: F.concat(a["done"], ended(a["open"], whole)))
    return F.array_sort(all_)


def _index(pages: DataFrame, tags: Sequence[str]) -> DataFrame:
    """pages (.., html) with a row for each element: pos, tag, from, to, and the page's markup m and texts t."""
    keys = [c for c in pages.columns if c != "html"]
    parts = pages.select(*keys, _parts(F.coalesce("html", F.lit(""))).alias("_p"))
    found = parts.select(*keys, F.col("_p.m").alias("_m"), F.col("_p.n").alias("_n"), F.col("_p.t").alias("_t"), F.explode(_elements(F.col("_p.n"), F.col("_p.m"), tags)).alias("_e"))
    # Only what lies between the tags goes on.
    inside = lambda c, more: F.slice(F.col(c), F.col("_e.from") + 1 + more, F.greatest(F.col("_e.to") - F.col("_e.from"), F.lit(0)))
    return found.select(*keys, F.col("_e.n").alias("pos"), F.col("_e.tag").alias("tag"), inside("_t", 1).alias("_t"), inside("_m", 0).alias("_m"), inside("_n", 0).alias("_n"), F.get("_m", F.col("_e.from")).alias("_own"))


def _text(texts: Column) -> Column:
    return strip(unescape(F.array_join(texts, "")))


def links(pages: DataFrame) -> DataFrame:
    """SRC-22: every link of pages (.., html): pos, href, text, title, img_alt and label, the first of these that isn't empty."""
    keys = [c for c in pages.columns if c != "html"]
    image = F.get(F.filter(F.arrays_zip(F.col("_n").alias("n"), F.col("_m").alias("m")), lambda x: x["n"] == "img"), 0)["m"]
    found = _index(pages, ("a",)).select(*keys, "pos", attribute(F.col("_own"), "href").alias("href"), _text(F.col("_t")).alias("text"), F.coalesce(attribute(F.col("_own"), "title"), F.lit("")).alias("title"), F.coalesce(F.when(image.isNotNull(), attribute(image, "alt")), F.lit("")).alias("img_alt"))
    label = F.coalesce(F.nullif("text", F.lit("")), F.nullif("title", F.lit("")), F.nullif("img_alt", F.lit("")))
    return found.where("href IS NOT NULL").withColumn("label", label)


def rows(pages: DataFrame, least: int = 1) -> DataFrame:
    """SRC-18, SRC-19: table rows with at least so many cells: row_no, cells. A cell is of the row opened last before it."""
    keys = [c for c in pages.columns if c != "html"]
    parts = pages.select(*keys, _parts(F.coalesce("html", F.lit(""))).alias("_p"))
    elements = parts.select(*keys, F.col("_p.t").alias("_t"), _elements(F.col("_p.n"), F.col("_p.m"), ("tr", "td", "th")).alias("_e"))
    # Rows by their places among the elements; each takes the elements up to the next.
    at = F.filter(F.transform("_e", lambda e, i: F.when(e["tag"] == "tr", i)), lambda i: i.isNotNull())
    spans = F.transform(F.col("_at"), lambda i, k: F.struct(k.alias("row_no"), F.slice(F.col("_e"), i + 2, F.greatest(F.coalesce(F.get("_at", k + 1), F.size("_e")) - i - 1, F.lit(0))).alias("cells")))
    each = elements.withColumn("_at", at).select(*keys, "_t", F.explode(spans).alias("_r"))
    cell = lambda e: _text(F.slice(F.col("_t"), e["from"] + 2, F.greatest(e["to"] - e["from"], F.lit(0))))
    return each.where(F.size("_r.cells") >= max(least, 1)).select(*keys, F.col("_r.row_no").alias("row_no"), F.transform("_r.cells", cell).alias("cells"))


def blocks(pages: DataFrame, tags: str = "p,div,h1,h2,h3,li,td,th") -> DataFrame:
    """SRC-21, EX-42: the text of each element of some kinds: pos, tag, block."""
    keys = [c for c in pages.columns if c != "html"]
    texts = F.filter(F.transform("_t", lambda t: strip(unescape(t))), lambda t: t != "")
    return _index(pages, tags.split(",")).select(*keys, "pos", "tag", F.array_join(texts, " | ").alias("block"))


def visible_text(html: Column) -> Column:
    """SRC-20: without scripts, styles, comments and tags, white space squeezed."""
    bare = F.regexp_replace(html, r"(?is)<(script|style|noscript|template)\b.*?</\1\s*>|<!--.*?-->", " ")
    bare = F.regexp_replace(bare, r"<[^>]*>", " ")
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(name), F.lit(char))
    return squeeze(bare)


def snippets(pages: DataFrame, words: str, most: int = 20) -> DataFrame:
    """SRC-21: per page the first different blocks with a word and a digit, of more than 10 and fewer than 400 characters."""
    from pyspark.sql import Window

    key = [c for c in pages.columns if c != "html"]
    b = blocks(pages).withColumn("block", squeeze(F.replace("block", F.lit(" | "), F.lit(" "))))
    fit = b.where(F.lower("block").rlike(words) & F.col("block").rlike(r"\d") & (F.length("block") > 10) & (F.length("block") < 400))
    seen = fit.groupBy(*key, "block").agg(F.min("pos").alias("pos"))
    w = Window.partitionBy(*key).orderBy("pos")
    return seen.withColumn("n", F.row_number().over(w)).where(F.col("n") <= most)
