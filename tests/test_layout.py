"""Tables out of spans against a plain version; key figures by their rule; how often spans are shuffled."""

import random

from fundlake.operators import curation, layout, tables

SPANS = "doc_id long, page_no int, x double, y double, text string, right double"


def made(r):
    """A page's spans: tables of some columns, a little askew, with gaps, headings and wrapped labels."""
    spans, y = [], 10.0
    for _ in range(r.randint(0, 3)):
        columns = [20.0 + 90 * c for c in range(r.randint(1, 4))]
        for _ in range(r.randint(1, 5)):
            for x in columns:
                for k in range(r.choice([0, 1, 1, 1, 2])):
                    spans.append((x + 14 * k + r.uniform(-3, 3), y + r.uniform(-1, 1), r.choice(["a", "12,5", " b ", "", None]), r.choice([None, x + 14 * k + 12])))
            if r.random() < 0.2:
                spans.append((20.0, y + 7, "een lange regel die over alles heen loopt", None))
                y += 8
            y += 12
        y += r.choice([5, 40])
    return spans


def plain(spans, step=4.0, apart=25.0, gap=8.0):
    own = sorted((y, x, t.strip(), x + 5 * len(t.strip()) if right is None else right) for x, y, t, right in spans if t is not None and t.strip())
    rows, blocks = [], []
    for i, s in enumerate(own):
        drop = s[0] - own[i - 1][0] if i else float("inf")
        if drop > apart:
            blocks.append([])
        if drop > step:
            rows = []
            blocks[-1].append(rows)
        rows.append(s)
    out = []
    for block in blocks:
        every = sorted((x, right, y, t, len(row) > 1, i) for i, row in enumerate(block) for y, x, t, right in row)
        cells, col, reach = {}, -1, None
        for x, right, y, t, several, i in every:
            if several:
                col += reach is None or x > reach + gap
                reach = right if reach is None else max(reach, right)
            cells.setdefault((i, max(col, 0)), []).append((x, y, t))
        last = max(c for _, c in cells)
        if len(block) > 1 and last > 0:
            out.append([[" ".join(t for _, _, t in sorted(cells.get((i, c), []))) for c in range(last + 1)] for i in range(len(block))])
    return out


def test_tables(spark):
    r = random.Random(1)
    pages = {(d, p): made(r) for d in range(30) for p in range(2)}
    rows = [(d, p, x, y, t, right) for (d, p), spans in pages.items() for x, y, t, right in spans] + [(99, 0, None, 1.0, "x", None), (99, 0, 1.0, None, "x", None)]
    got = {}
    for x in tables.tables(spark.createDataFrame(rows, SPANS).repartition(5)).collect():
        got.setdefault((x.doc_id, x.page_no), {})[x.table_no] = x.rows
    assert {k: [v[i] for i in range(len(v))] for k, v in got.items()} == {k: found for k, spans in pages.items() if (found := plain(spans))}


def test_spans_without_right_edge_and_fees(spark):
    rows = [(1, 0, 10.0, 5.0, "Kosten"), (1, 0, 200.0, 6.0, "2022"), (1, 0, 300.0, 4.0, "2023"), (1, 0, 10.0, 20.0, "Performance"), (1, 0, 70.0, 20.0, "fee"), (1, 0, 300.0, 21.0, "2.500"), (2, 0, 10.0, 5.0, "Kosten"), (2, 0, 200.0, 5.0, "1"), (1, 100, 1.0, 1.0, "performance fee")]
    spans = spark.createDataFrame(rows, "doc_id long, page_no int, x double, y double, text string")
    found = tables.tables(tables.keyword_pages(spans, ("performance fee",)))
    assert [(x.doc_id, x.page_no, x.table_no, x.rows) for x in found.collect()] == [(1, 0, 0, [["Kosten", "2022", "2023"], ["Performance fee", "", "2.500"]])]
    assert [tuple(x) for x in curation.table_fees(found).collect()] == [(1, 2.5)]


def test_one_shuffle(spark):
    spans = spark.createDataFrame([(1, 0, 1.0, 1.0, "x", None)], SPANS)
    for df in (tables.tables(spans), layout.key_figures(spans.drop("right"))):
        assert df._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1


def test_key_figures(spark):
    def page(n, *rows):
        return [(1, n, x, y, t) for y, items in rows for x, t in items]

    head = (50.0, [(100.0, "2023"), (200.0, "2022"), (300.0, "2021")])
    word = (10.0, [(10.0, "Kerncijfers")])
    spans = page(0, word, (50.0, [(100.0, "2023"), (200.0, "2022")]), (70.0, [(10.0, "CPI"), (100.0, "9,9")]))  # two years are no header
    spans += page(1, word, head, (40.0, [(10.0, "CPI"), (100.0, "1,1")]), (70.0, [(10.0, "Toeslag en CPI"), (150.0, "2,5%"), (290.0, "-3")]), (80.0, [(10.0, "cpi"), (100.0, "7"), (200.0, "8")]))
    spans += page(2, word, head, (70.0, [(10.0, "Rendement"), (101.0, "0"), (201.0, "4,5")]))
    spans += page(20, word, head, (70.0, [(10.0, "Rendement"), (301.0, "6")]))
    got = {r.year: r.asDict() for r in layout.key_figures(spark.createDataFrame(spans, "doc_id long, page_no int, x double, y double, text string")).collect()}
    some = {y: {k: v for k, v in r.items() if v is not None and k not in ("doc_id", "year")} for y, r in got.items()}
    assert some == {2023: {"indexatieverlening_pct": 2.5, "cpi_pct": 2.5}, 2022: {"cpi_pct": 8.0}, 2021: {"indexatieverlening_pct": -3.0, "cpi_pct": -3.0}}
