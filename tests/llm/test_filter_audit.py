"""Filter audit against a plain version that walks every order."""

import random
from collections import defaultdict
from itertools import permutations

import pytest

from fundlake.llm import filter_audit

DOCS = "doc_id long, text string, source string"
LABELS = "doc_id long, quality int, toxic int"
LETTERS = "ABCDE"


def made():
    r = random.Random(2)
    vocabulary = [f"w{i}" for i in range(90)]
    rows = []
    for i in range(150):
        words = [r.choice(vocabulary[: r.choice([20, 90])]) for _ in range(r.choice([5, 49, 50, 51, 80, 120]))]
        if r.random() < 0.3:
            words[r.randrange(len(words))] = r.choice(["a#b", "$", "x|y"])
        if r.random() < 0.3:
            words = [w.upper() if r.random() < 0.4 else w for w in words]
        rows.append((i, r.choice([" ", "\n", "\t", "\v"]).join(words), r.choice(["s1", "s1", "s2", None, ""])))
    rows += [(200 + i, rows[i % 7][1], r.choice(["s1", "s3", None])) for i in range(60)]
    rows += [(300, None, "s1"), (301, "", "s1"), (302, None, "s2"), (303, "É" * 10 + " \U0001f600", "s4"), (304, "A" * 6 + "b" * 114, "s4"), (305, "A" * 5 + "b" * 95, "s4")]
    rows += [(None, rows[0][1], "s1"), (None, rows[0][1], "s1"), (None, "unlike", None), (5, rows[5][1], rows[5][2]), (5, rows[5][1], "s9"), (5, rows[6][1], "s9")]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1])) for i in range(0, 310, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (999, 1, 1)]
    return rows, labels


def fails(rows):
    """The letters that each row fails."""
    least = {}
    for d, t, _ in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    for d, t, _ in rows:
        t = t or ""
        w = t.encode().split()
        found = set()
        if len(w) < 50:
            found.add("A")
        if 100 * len(set(w)) < 65 * len(w):
            found.add("B")
        if 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t):
            found.add("C")
        if any(c in "#$%&*|" for c in t):
            found.add("D")
        if d is not None and d > least[t]:
            found.add("E")
        yield found


def expected(rows, labels):
    good, toxic = ({d for d, *v in labels if d is not None and v[i] == 1} for i in (0, 1))
    parts = defaultdict(list)
    for (d, _, source), f in zip(rows, fails(rows), strict=True):
        parts[source or ""].append((f, d in good, d in toxic))
    out = {}
    for part, docs in parts.items():
        total = defaultdict(int)
        for order in permutations(LETTERS):
            left = docs
            for step, letter in enumerate(order, 1):
                gone = [x for x in left if letter in x[0]]
                left = [x for x in left if letter not in x[0]]
                failing = [x for x in docs if letter in x[0]]
                total[letter] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), len(failing) - len(gone), sum(x[0] == {letter} for x in docs), sum(x[1] for x in gone), sum(x[2] for x in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(total[order[step - 1]])
    return out


def test_audit(spark):
    rows, labels = made()
    got = filter_audit.audit(spark.createDataFrame(rows, DOCS).repartition(3), spark.createDataFrame(labels, LABELS))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert dict(got.dtypes) == {"part": "string", "filter_order": "string", "step": "int"} | dict.fromkeys(got.columns[3:], "bigint")
    found = got.collect()
    plain = expected(rows, labels)
    assert len(found) == len(plain)
    assert {tuple(r[:3]): list(r[3:]) for r in found} == plain


def test_clashing_columns_and_types(spark):
    """Ids may be text, and columns of the inputs may be named like the operator's own."""
    rows = [("=a", "x " * 60, "p", 1, "m"), ("b", "x " * 60, "p", 2, "n"), (None, "x " * 60, "p", 3, None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string, mask int, k string")
    labels = spark.createDataFrame([("b", 1, 0, "z")], "doc_id string, quality int, toxic int, part string")
    got = {(r.filter_order, r.step): r for r in filter_audit.audit(docs, labels).collect()}
    assert got["EABCD", 1].removed == 1 and got["EABCD", 1].kept == 2 and got["EABCD", 1].good_lost == 1


def test_own_filters(spark):
    docs = spark.createDataFrame([(1, "a b", "s"), (2, "a b", "s"), (3, "long " * 9, "s")], DOCS)
    got = {(r.filter_order, r.step): r for r in filter_audit.audit(docs, spark.createDataFrame([], LABELS), {"S": "n_words < 3"}, "D").collect()}
    assert {k: (r.kept, r.removed, r.redundant, r.shapley) for k, r in got.items()} == {("SD", 1): (1, 2, 0, 3), ("SD", 2): (1, 0, 1, 1), ("DS", 1): (2, 1, 0, 1), ("DS", 2): (1, 1, 1, 3)}
    with pytest.raises(ValueError, match="one letter"):
        filter_audit.audit(docs, docs, {"S": "true"}, "S")


def test_edges(spark):
    assert filter_audit.audit(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).collect() == []
    long = spark.createDataFrame([(1, "word " * 300_000, None), (2, "word " * 300_000, None)], DOCS)
    got = {(r.part, r.filter_order, r.step): r for r in filter_audit.audit(long, spark.createDataFrame([], LABELS)).collect()}
    assert len(got) == 600 and got["", "BEACD", 1].removed == 2 and got["", "EBACD", 1].removed == 1
