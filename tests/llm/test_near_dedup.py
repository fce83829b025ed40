"""Near dedup against all pairs of full sets."""

import random

import pytest

from fundlake.llm import components, near_dedup

SCHEMA = "doc_id long, text string"


def brute(rows, n=5, percent=75):
    words = {}
    for i, (_, text) in enumerate(rows):
        w = (text or "").encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))).split()
        words[i] = frozenset(tuple(w[k : k + n]) for k in range(max(len(w) - n, 0) + 1)) if w else frozenset()
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(words[i] & words[j])
            if words[i] and 100 * both >= percent * len(words[i] | words[j]):
                up[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    return sorted(((d, len(words[i]), min((x for x in groups[find(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows)), key=str)


def corpus():
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [r.choice(vocabulary) for _ in range(160)]
    rows = [(1000, " ".join(base))]
    for i in range(40):  # a large group of near copies, from near to far
        w = list(base)
        for _ in range(r.randint(1, 9)):
            w[r.randrange(len(w))] = f"x{r.random()}"
        rows.append((i, " ".join(w)))
    for i in range(40, 60):  # a passage that many share, in texts of their own
        rows.append((i, " ".join(base[:50] + [r.choice(vocabulary) for _ in range(150)])))
    rows += [(60, rows[3][1]), (61, rows[3][1].upper()), (62, None), (63, ""), (64, " \n "), (65, "one two"), (66, "ONE two"), (67, "a " * 3000), (68, "a " * 10)]
    rows += [(70, " ".join(r.choice(vocabulary) for _ in range(20000)))]
    return rows


@pytest.mark.parametrize(("part", "long"), [(256, 64), (4, 3)])
def test_against_all_pairs(spark, monkeypatch, part, long):
    monkeypatch.setattr(near_dedup, "PART", part)
    monkeypatch.setattr(near_dedup, "LIST", long)
    rows = corpus()
    got = near_dedup.near_groups(spark.createDataFrame(rows, SCHEMA)).collect()
    expected = [(d, n, c if n else d) for d, n, c in brute(rows)]
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == sorted(expected, key=str)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_keep_one_keeps_columns_and_one_row_of_each_group(spark):
    rows = [(2, "a b c d e f", "x", 1), (1, "A b c d e f", "y", 2), (3, "", "z", 3), (4, None, None, 4), (1, "A b c d e f", "y", 2), (None, "q r s t u", "n", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block string, row int")
    got = near_dedup.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or -1, r.row) for r in got.collect()) == [(-1, 5), (1, 2), (3, 3), (4, 4)]


def test_empty_table(spark):
    assert near_dedup.near_groups(spark.createDataFrame([], SCHEMA)).collect() == []


def test_sets_that_share_a_name_stay_apart(spark):
    rows = [(0, 0, 1, 5, 7, 1), (0, 1, 2, 5, 7, 2), (0, 2, 3, 5, 7, 1), (0, 3, 4, 5, 8, 3), (0, 4, 5, 0, 7, 9)]
    df = spark.createDataFrame(rows, "block long, row long, doc_id long, size long, cls long, twin long")
    got = {r.doc_id: r.cls for r in near_dedup.told_apart(df).collect()}
    assert got[1] == got[3] != got[2] and got[4] == 8
    assert near_dedup.told_apart(df.where("doc_id <> 2 AND size > 0")).columns == ["block", "row", "doc_id", "size", "cls"]


def test_frequent_keys_are_joined_apart(spark, monkeypatch):
    monkeypatch.setattr(components, "HOT", 5)
    rows = [(1, i) for i in range(50)] + [(k, k) for k in range(2, 30)] + [(None, 7), (2, 2)]
    df, table = spark.createDataFrame(rows, "k long, x long"), spark.createDataFrame([(k, f"v{k}") for k in range(20)], "k long, v string")
    got = sorted((tuple(r) for r in components.spread_join(df, table, "k", len(rows)).select("k", "x", "v").collect()), key=str)
    assert got == sorted(((k, x, f"v{k}" if k is not None and k < 20 else None) for k, x in rows), key=str)


@pytest.mark.parametrize("k", [5, 12, 40])
def test_pairs_at_the_threshold(spark, k):
    """Sets of 7k shingles that share 6k have a similarity of 0.75 exactly; those that share one less stay apart."""
    rows = []
    for pair in range(150):
        shared = 6 * k - pair % 2
        own = [f"p{pair}w{i}" for i in range(7 * k + 4)]
        other = own[: shared + 4] + [f"p{pair}v{i}" for i in range(7 * k - shared)]
        rows += [(2 * pair, " ".join(own)), (2 * pair + 1, " ".join(other))]
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(spark.createDataFrame(rows, SCHEMA)).collect()}
    for pair in range(150):
        assert got[2 * pair + 1] == (2 * pair if pair % 2 == 0 else 2 * pair + 1)
