"""Collocations against a plain version, the automaton against all substrings, scores of large counts."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from fundlake.llm import collocations

DOCS = "doc_id long, text string, lang string"


def made(seed=5):
    r = random.Random(seed)
    words = ["the", "The", "of", "é", "new", "york", "a", "b", "x y", "q-r"]
    rows = []
    for i in range(120):
        text = "".join(r.choice(words) + r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "; ", "\v"]) for _ in range(r.randint(0, 60)))
        if i % 3 == 0:
            text += " san francisco bay area north side"
        rows.append((i, text, r.choice(["en", "en", "fr", None, "und"])))
    return rows + [(None, "new york " * 30, "en"), (7, "new york", "en"), (7, "new york", "en"), (200, None, "de"), (201, "", "de"), (202, " . ,", "xx")]


def counted(rows):
    """Words of each language, and occurrences of each phrase."""
    n, f = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    return n, f


def expected(rows, least, most):
    n, f = counted(rows)
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    inside = lambda x, y: any(y[i : i + len(x)] == x for i in range(len(y) - len(x) + 1))
    out = []
    for (lang, p), a in candidates.items():
        if any(o == lang and len(q) > len(p) and b >= a and inside(p, q) for (o, q), b in candidates.items()):
            continue
        s, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.append((lang, -s, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    ranks, rows = Counter(), set()
    for lang, s, a, p, left, right in sorted(out):
        ranks[lang] += 1
        if ranks[lang] <= most:
            rows.add((lang, ranks[lang], p.decode(), -a, left, right, n[lang], -s))
    return rows


@pytest.mark.parametrize(("least", "most"), [(3, 2000), (8, 10), (1, 5)])
def test_collocations(spark, least, most):
    rows = made()
    got = collocations.collocations(spark.createDataFrame(rows, DOCS).repartition(3), least, most)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for _, t in got.dtypes} == {"string", "bigint"}
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == expected(rows, least, most)


def test_many_shards(spark, monkeypatch):
    """Counts and subsumption hold over shards of a few texts each: a phrase may be extended alike in one and not in another."""
    monkeypatch.setattr(collocations.blocks.pack, "__defaults__", (64,))
    monkeypatch.setattr(collocations.blocks.store, "__defaults__", (64,))
    rows = made(6)
    found = {tuple(r) for r in collocations.collocations(spark.createDataFrame(rows, DOCS).repartition(5), 4).collect()}
    assert found == expected(rows, 4, 2000)


@pytest.mark.parametrize("seed", range(4))
def test_automaton(seed):
    r = np.random.default_rng(seed)
    ids = r.integers(0, 3, 400)
    joined = r.random(400) < 0.8
    joined[0] = False
    runs = np.split(ids, np.flatnonzero(~joined)[1:])
    ends = {}  # of each substring
    at = 0
    for run in runs:
        for i in range(len(run)):
            for k in range(1, min(i + 1, 5) + 1):
                if len(run) > 1:
                    ends.setdefault(tuple(run[i - k + 1 : i + 1].tolist()), set()).add(at + i)
        at += len(run)
    at = np.arange(400)
    a = collocations.Automaton(ids, np.minimum(at - np.maximum.accumulate(np.where(joined, 0, at)), 4))
    states = {}
    for s in range(len(a.first)):
        own = frozenset(a.places[a.first[s] : a.first[s] + a.count[s]].tolist())
        at = a.places[a.first[s]]
        for k in range(a.least[s] + 1, a.most[s] + 1):
            states[tuple(ids[at - k + 1 : at + 1].tolist())] = own
        if a.link[s] >= 0:  # the longest suffix that ends elsewhere too
            link = a.link[s]
            assert a.most[link] == a.least[s] and own < frozenset(a.places[a.first[link] : a.first[link] + a.count[link]].tolist())
        else:
            assert a.least[s] == 0
    assert states == {k: frozenset(v) for k, v in ends.items()}
    classes = {(v, k[-1]) for k, v in states.items()}
    assert len(classes) == len(a.first)  # one state a class
    found = {tuple(ids[e - n + 1 : e + 1].tolist()): c for n, at, count in a.substrings(1) for e, c in zip(at, count, strict=True)}
    assert found == {k: len(v) for k, v in ends.items()}


def test_numbers_packed():
    r = np.random.default_rng(1)
    for n in (0, 1, 1000):
        values = [r.integers(0, 1 << 32, n), r.integers(0, 3, n)]
        assert [x.tolist() for x in collocations.unpacked(collocations.packed(values), n, 2)] == [v.tolist() for v in values]


def test_crowded_slots(spark, monkeypatch):
    """With hardly any slots all seems frequent; the result stays the same."""
    monkeypatch.setattr(collocations, "SLOTS", 1)
    monkeypatch.setattr(collocations, "SLOT_BYTES", 1 << 22)
    monkeypatch.setattr(collocations, "PARTS", 2)
    rows = made(7)
    assert {tuple(r) for r in collocations.collocations(spark.createDataFrame(rows, DOCS).repartition(2), 5).collect()} == expected(rows, 5, 2000)


def test_automaton_of_nothing():
    a = collocations.Automaton(np.zeros(0, np.int32), np.zeros(0, int))
    assert not len(a.first) and list(a.substrings()) == []
    a = collocations.Automaton(np.array([1, 2]), np.zeros(2, int))
    assert not len(a.first)


def test_large_counts(spark):
    """Products beyond 64 bits, and ties of cuts after flooring."""
    a, n = 9 * 10**11, 7 * 10**13
    parts = [("x", 1, 10**12), ("y", 1, 10**12 + 7), ("z", 1, 10**12), ("x y", 2, 10**12), ("y z", 2, 10**12), ("x y z", 3, a)]
    phrases = spark.createDataFrame([("en", p, w, c) for p, w, c in parts], "lang string, phrase string, words long, a long")
    got = collocations.scored(phrases.where("words > 2"), phrases, spark.createDataFrame([("en", n)], "lang string, n long")).first()
    assert got.score == 1000 * a * n // (10**12 * 10**12) and (got.l, got.r) == (10**12, 10**12)


def test_edges(spark):
    assert collocations.collocations(spark.createDataFrame([], DOCS)).collect() == []
    assert collocations.collocations(spark.createDataFrame([(1, None, None), (2, "", "en"), (3, " \t.", "en")], DOCS), 1).collect() == []
    long = "red green " * 150_000
    rows = [(1, long, "en", 5, "x"), (None, "blue " * 3, None, None, "y")]
    got = [tuple(r) for r in collocations.collocations(spark.createDataFrame(rows, "doc_id long, text string, lang string, phrase long, a string"), 2).collect()]
    assert {r[0] for r in got} == {"en", "und"}
    assert {(r[2], r[3]) for r in got if r[0] == "und"} == {("blue blue", 2)}
    assert {(r[2], r[3]) for r in got if r[0] == "en"} == {("red green", 150_000), ("red green red green", 149_999), ("red green red green red", 149_998), ("green red green red green", 149_998)}
    one_word = [(i, "word", "en") for i in range(5)]
    assert collocations.collocations(spark.createDataFrame(one_word, DOCS), 1).collect() == []
