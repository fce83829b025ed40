"""The index of elements against the standard library's parser."""

import html as names
import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from fundlake.plans import documents, reports  # noqa: F401  (they register their queries)
from fundlake.plans.registry import QUERIES
from fundlake.sources import html

PAGES = "page_id long, html string"
SILENT = {"script", "style", "noscript", "template"}


class Parser(HTMLParser):
    """Elements of some tags: number, tag, attributes, texts and the first image's alternative text."""

    def __init__(self, wanted):
        super().__init__(convert_charrefs=True)
        self.wanted, self.open, self.done, self.silent, self.seen = set(wanted), [], [], 0, 0

    def handle_starttag(self, tag, attrs):
        self.silent += tag in SILENT
        if tag == "img":
            for x in self.open:
                x.setdefault("alt", dict(attrs).get("alt") or "")
        if tag in self.wanted:
            self.open.append({"n": self.seen, "tag": tag, "attrs": dict(attrs), "text": []})
            self.seen += 1

    def handle_endtag(self, tag):
        if tag in SILENT:
            self.silent = max(0, self.silent - 1)
        if any(x["tag"] == tag for x in self.open):
            while True:
                self.done.append(self.open.pop())
                if self.done[-1]["tag"] == tag:
                    break

    def handle_data(self, data):
        if not self.silent:
            for x in self.open:
                x["text"].append(data)

    def items(self, text):
        self.feed(text or "")
        self.close()
        return sorted(self.done + self.open, key=lambda x: x["n"])


def links(text):
    return [(x["n"], x["attrs"]["href"] or "", "".join(x["text"]).strip(), x["attrs"].get("title") or "", x.get("alt", "")) for x in Parser({"a"}).items(text) if "href" in x["attrs"]]


def rows(text):
    out = []
    for x in Parser({"tr", "td", "th"}).items(text):
        if x["tag"] == "tr":
            out.append([])
        elif out:
            out[-1].append("".join(x["text"]).strip())
    return [(i, r) for i, r in enumerate(out) if r]


def blocks(text):
    return [(x["n"], x["tag"], " | ".join(t for t in (s.strip() for s in x["text"]) if t)) for x in Parser({"p", "div", "li", "td"}).items(text)]


def made():
    r = random.Random(1)
    tags = ["a", "tr", "td", "th", "p", "div", "li", "table", "b", "noscript", "template"]
    attrs = ["", "", " href=x", " href='a b'", ' href="c>d" title="t &amp; u"', " HREF", " title=' href=no '", ' href="1" href="2"', " class=x href = y ", ' data-href="z"']
    voids = ["<br>", "<br/>", "<img alt='plaatje'>", "<img src=x>", "<hr >", "<td/>", "<a href=self />", "<!-- c <a href=q> -->", "<!DOCTYPE html>", "<script>if (a < b) { x = '<a href=q>' }</script>", "<style>p > a {}</style>", "<SCRIPT src='>'>y</SCRIPT>", "</nothing>", "</a>", "</tr>", "</td>"]
    words = ["tekst", " ", "een &amp; twee", "&eacute;&copy&#233;&#xe9;", "\n", "&onzin;", "& los", "5&euro;", "&notit;", "a&lt;b", "&#0;&#128;&#x110000;", "\u00a0", "\U0001f600"]
    pages = []
    for _ in range(250):
        out, open_ = "", []
        for _ in range(r.randint(0, 40)):
            k = r.random()
            if k < 0.3:
                open_.append(r.choice(tags))
                out += f"<{open_[-1] if r.random() < 0.9 else open_[-1].upper()}{r.choice(attrs)}>"
            elif k < 0.55 and open_:
                out += f"</{open_.pop(r.choice([-1, -1, -1, r.randrange(len(open_))]))}>"
            elif k < 0.65:
                out += r.choice(voids)
            else:
                out += r.choice(words)
        pages.append(out)
    return list(enumerate([*pages, None, "", "<a href=x>open tot het eind", "<a href=1><a href=2>in</a>uit</a>", "<tr><td>a<td>b<tr><th>c</table>", "<td>los<tr><td><table><tr><td>in</td></tr></table>na</td><td>x</td></tr>"]))


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(made(), PAGES).repartition(4).cache()


def by_page(df, *columns):
    out = {}
    for x in sorted(df.collect(), key=lambda x: x[columns[0]]):
        out.setdefault(x.page_id, []).append(tuple(x[c] for c in columns))
    return out


def nonempty(f):
    return {i: found for i, text in made() if (found := f(text))}


def test_links(pages):
    assert by_page(html.links(pages), "pos", "href", "text", "title", "img_alt") == nonempty(links)


def test_rows(pages):
    assert by_page(html.rows(pages), "row_no", "cells") == nonempty(rows)
    assert by_page(html.rows(pages, 2), "row_no", "cells") == nonempty(lambda t: [x for x in rows(t) if len(x[1]) > 1])


def test_blocks(pages):
    assert by_page(html.blocks(pages, "p,div,li,td"), "pos", "tag", "block") == nonempty(blocks)


def test_references(spark):
    texts = ["&amp;", "&ampx;", "a & b &", "&#65;&#x41;&#X41;", "&#65", "&notin;", "&notit;", "&copycat", "&#0;&#13;&#11;&#129;&#150;", "&#xD800;&#x110000;&#99999999999999999999;", "&#xfffe;&#x1F600;", "&nope;", "&NotEqualTilde;", "&;&#;&#x;", "&a", "", None, "geen"]
    got = spark.createDataFrame([(x,) for x in texts], "t string").select("t", html.unescape(F.col("t")).alias("u")).collect()
    assert [r.u for r in got] == [None if x is None else names.unescape(x) for x in texts]


def test_long_pages(spark):
    page = "<table>" + "".join(f"<tr><td>{i}</td><td>b &amp; c</td></tr>" for i in range(1500)) + "</table>" + "<p " + "x='y' " * 3000 + ">t</p>" + "x" * 2_000_000
    got = html.rows(spark.createDataFrame([(1, page)], PAGES))
    assert got.count() == 1500 and got.where("row_no = 1499").first().cells == ["1499", "b & c"]
    assert html.blocks(spark.createDataFrame([(1, page)], PAGES), "p").first().block == "t"


@pytest.mark.parametrize("name", ["q_links", "q_table_rows", "q_table_rows_of_four", "q_resolved_links"])
def test_no_python_on_executors(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "InArrow" not in plan and "Python" not in plan and "Pandas" not in plan
