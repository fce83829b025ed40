"""Operators against brute force, on small tables with nulls, empty and repeated rows."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fundlake.llm import chat, ctw, decontaminate, line_dedup, mixing, pii, quality, substring_dedup, tokens, topk

DOCS = "doc_id long, text string"
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
sha = lambda s: hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def split(text):
    return (text or "").encode().split()


def texts(seed=1, n=60):
    r = random.Random(seed)
    v = [f"w{i}é" if i % 7 == 0 else f"W{i}" for i in range(60)]
    passage = " ".join(r.choice(v) for _ in range(50))
    rows = [(i, " ".join(r.choice(v) for _ in range(r.randint(1, 120)))) for i in range(n)]
    rows += [(n + i, f"{rows[i][1]}\n{passage} {rows[i + 1][1]}") for i in range(8)]
    rows += [(900, "a " * 200), (901, "a " * 36), (902, None), (903, ""), (904, "  \n "), (905, rows[0][1]), (None, rows[1][1]), (906, "x y " * 90)]
    return rows


def test_tokens_hash_by_content():
    column = pa.array(["ab  cd\tab", None, "", "é cd", "ab"])
    w = tokens.words_of(column)
    h = w.hashes().tolist()
    assert w.counts().tolist() == [3, 0, 0, 2, 1]
    assert h[0] == h[2] == h[5] and h[1] == h[4] and len(set(h)) == 3


def test_substring_dedup(spark):
    rows = texts()
    seen = Counter()
    for _, t in rows:
        w = split(t)
        seen.update(tuple(w[i : i + 35]) for i in range(len(w) - 34))
    expected = []
    for d, t in rows:
        w = split(t)
        gone = set()
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                gone.update(range(i, i + 35))
        expected.append((d, len(w), len(gone), sha(b" ".join(x for i, x in enumerate(w) if i not in gone))))
    got = [tuple(r) for r in substring_dedup.window_report(spark.createDataFrame(rows, DOCS)).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_remove_repeats_keeps_columns(spark):
    rows = [(1, "a b " * 40, "s"), (2, "c d", None)]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string, block string")).collect()
    assert {(r.doc_id, r.text, r.block) for r in got} == {(1, "", "s"), (2, "c d", None)}


def test_line_dedup(spark):
    line = "x" * 39 + "É"
    rows = [(i, f"  {line.upper() if i % 2 else line}\t\nshort {i}") for i in range(6)] + [(10, None), (11, ""), (None, line), (7, "y" * 40), (8, "y" * 40)]
    got = {r.doc_id: r for r in line_dedup.line_report(spark.createDataFrame(rows, DOCS)).collect()}
    # The upper-case É keeps its case, and A-Z folds: all six and the one without an id share the key.
    assert [got[i].n_dropped for i in range(6)] == [1, 1, 1, 1, 1, 0] and got[None].n_dropped == 1
    assert got[10].n_lines == 1 and got[10].kept_sha256 == sha("") and got[7].n_dropped == 0
    assert got[0].kept_sha256 == sha("short 0")


def test_perfect_hash_is_minimal_and_survives_storage():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)
    table = line_dedup.PerfectHash.load(line_dedup.PerfectHash.build(keys).dump())
    assert sorted(table.index(keys).tolist()) == list(range(len(np.unique(keys))))


def hits(rows, items, n=10):
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: word.findall((t or "").encode().translate(LOWER))
    windows = {}
    for i, t in items:
        w = low(t)
        for k in range(max(len(w) - n, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add("null" if i is None else str(i))
    out = []
    for d, t in rows:
        w, hit, names = low(t), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    hit.update(range(k, k + size))
                    names |= windows[tuple(w[k : k + size])]
        out.append((d, len(w), len(hit), len(names), sha(",".join(sorted(names))), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("chunk", "terms"), [(decontaminate.CHUNK_BYTES, decontaminate.MAX_TERMS), (300, decontaminate.MAX_TERMS), (300, 5)])
def test_decontamination(spark, monkeypatch, chunk, terms):
    monkeypatch.setattr(decontaminate, "MAX_TERMS", terms)
    monkeypatch.setattr(decontaminate, "CHUNK_BYTES", chunk)
    rows = texts(2)
    items = [(i, " ".join((rows[i][1] or "").split()[3:20])) for i in range(12)] + [(20, "a a"), (21, None), (22, "!!"), (None, "w7é-W8"), (30, rows[3][1].upper())]
    got = [tuple(r) for r in decontaminate.contamination(spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, "item_id long, text string")).collect()]
    assert sorted(got, key=str) == hits(rows, items)


def test_decontaminate_drops_and_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "one two three", "k"), (1, "four", "k"), (2, None, None)], "doc_id long, text string, row string")
    got = decontaminate.decontaminate(docs, spark.createDataFrame([(1, "ONE, two")], "item_id long, text string"))
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == [1, 2]
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(docs, none).count() == 3
    assert decontaminate.contamination(docs, none).where("contaminated").count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a x x b"), (2, "a x x x x x b"), (3, "b a"), (4, "a"), (5, "a a b")], DOCS)
    got = sorted((r.doc_id, r.position) for r in decontaminate.proximity(docs, ["A", "b"], 3).collect())
    assert {d for d, _ in got} == {1, 3, 5}


def test_pii(spark):
    texts_ = ["mail a.b@c.de@f.gh x_y@z", "ip 1.2.3.4.5 and 300.1.1.1 at 10.0.0.255", "card 4111 1111 1111 1111, 4111-1111-1111-1112", "call +31 (20) 123-4567 or +1 2", "iban GB82 WEST 1234 5698 7654 32. DE00370400440532013000", "my ssn is 123-45-6789; 123-45-6789", None, "", "é" * 5 + " q@r.st", "9" * 30000, "a" * 50000 + "@"]
    got = {r.doc_id: r for r in pii.report(spark.createDataFrame(list(enumerate(texts_)), DOCS)).collect()}
    assert got[0].spans == "email:5:13"
    assert got[1].spans == "ip:3:10,ip:30:40" and got[2].spans == "card:5:24" and got[3].n_phone == 1
    assert got[4].n_iban == 1 and got[5].n_ssn == 2
    assert got[6].spans == got[7].spans == "" and got[6].base_sha256 == sha("")
    assert got[8].spans == "email:6:12" and got[9].n_card == 0 and got[10].n_email == 0
    kept = {r.doc_id: r.text for r in pii.redact(spark.createDataFrame([(1, "to q@r.st, é +31 20 1234567!"), (2, None)], DOCS)).collect()}
    assert kept[1] == "to <email>, é <phone>!" and kept[2] == ""


def test_pii_of_very_long_texts(spark):
    """Hundreds of thousands of spans, long runs that are none, and the context of a far one."""
    n = 60000
    rows = [(1, " ".join(f"u{i}@é.h{i % 9}.nl" for i in range(n))), (2, "9" * 500000), (3, "1 " * 250000), (4, "+1 (2) " * 70000), (5, "é " * 300000 + "my ssn 123-45-6789"), (6, "é " * 300000 + "my xxx 123-45-6789"), (6, "é " * 300000 + "my xxx 123-45-6789")]
    got = {x.doc_id: x for x in pii.report(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[1].n_email == 0 and [got[i].spans for i in (2, 3, 4, 6)] == [""] * 4
    assert got[5].spans == "ssn:600007:600018"
    rows = [(1, " ".join(f"u{i}@h{i % 9}.nl" for i in range(n))), (2, "x " * 3000 + "a@b.cd " + "y " * 3000 + "c@d.ef")]
    assert pii.report(spark.createDataFrame(rows, DOCS)).where("doc_id = 1").first().n_email == n
    assert [x.text for x in pii.redact(spark.createDataFrame(rows, DOCS)).orderBy("doc_id").collect()] == [" ".join(["<email>"] * n), "x " * 3000 + "<email> " + "y " * 3000 + "<email>"]


def test_pii_redacts_overlapping_spans_as_one(spark):
    text = "+4111 1111 1111 1111 x 1.2.3.4@b.cd, a@b.cd"
    assert pii.redact(spark.createDataFrame([(1, text)], DOCS)).first().text in {"<card> x <email>, <email>", "<phone> x <email>, <email>", "+<card> x <email>, <email>"}


def brute_pii(text):
    out = []
    luhn = lambda d: sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(d := re.sub(r"\D", "", m)) <= 19 and luhn(d)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub(r"\D", "", m)) <= 15),
    )
    for k, (kind, p, ok) in enumerate(kinds):
        out += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(p, text) if ok(m[0])]
    return ",".join(x for *_, x in sorted(out))


def test_pii_base_spans_against_python(spark):
    r = random.Random(5)
    alphabet = list("0123456789") * 3 + list("ab@.-+ ()_%é")
    rows = [(i, "".join(r.choice(alphabet) for _ in range(r.randint(0, 300)))) for i in range(300)]
    got = {x.doc_id: x.base_sha256 for x in pii.report(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {i: sha(brute_pii(t)) for i, t in rows}


def test_mixing(spark):
    r = random.Random(4)
    rows = [(i, " ".join(["w"] * r.choice([1, 5, 40, 300])), r.choice(["a"] * 8 + ["b", "c", None])) for i in range(1500)] + [(9000, None, "a"), (9001, "", "z"), (None, "w w", "a")]
    out = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    got = out.collect()
    assert len(got) == len(rows) and all(x.taken <= 3 * x.size and x.taken == x.size * x.copies for x in got)
    by = {}
    for x in got:
        s = by.setdefault(x.source, [0, 0, x.target, x.source_size])
        s[0], s[1] = s[0] + x.size, s[1] + x.taken
    assert all(size == stated for size, _, _, stated in by.values())
    total, names = sum(v[0] for v in by.values()), sorted((k for k in by if k is not None)) + [None]
    weight = {k: (5, 2, 1)[i % 3] for i, k in enumerate(names)}
    capped = set()
    while True:  # shares, again and again without those at their cap
        rest = total - sum(3 * by[k][0] for k in capped)
        level = rest / max(1e-9, sum(w for k, w in weight.items() if k not in capped))
        more = {k for k in names if k not in capped and level * weight[k] > 3 * by[k][0]}
        if not more:
            break
        capped |= more
    for k in names:
        wanted = 3 * by[k][0] if k in capped else level * weight[k]
        assert math.isclose(by[k][2], wanted, rel_tol=1e-9, abs_tol=1e-6) and abs(by[k][1] - wanted) <= 0.02 * wanted + 5
    again = {(x.doc_id, x.taken) for x in mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert again == {(x.doc_id, x.taken) for x in got}
    assert mixing.mix_sources(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


def test_balance_with_overlapping_groups(spark):
    cells = spark.createDataFrame([("1", ["a", "x"], 100), ("2", ["a", "y"], 50), ("3", ["b", "x"], 30), ("4", ["b", "y"], 120)], "cell string, groups array<string>, tokens long")
    wanted = {"a": 120.0, "b": 180.0, "x": 160.0, "y": 140.0}
    m = mixing.balance(cells, wanted)
    taken = {r.cell: r.tokens * math.exp(sum(m[g] for g in r.groups)) for r in cells.collect()}
    for g, v in wanted.items():
        assert math.isclose(sum(taken[r.cell] for r in cells.collect() if g in r.groups), v, rel_tol=1e-6)


def test_top_k(spark):
    r = np.random.default_rng(6)
    vectors = {i: (r.standard_normal(16) * 0.4).tolist() for i in range(300)}
    vectors |= {300 + i: vectors[0] for i in range(40)} | {400: None, 401: [0.1, None] * 8, 402: [float("nan")] * 16, 403: [float("inf")] * 16, 404: [0.5] * 9, 420: [0.0] * 16}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    got = [tuple(x) for x in topk.top_k(df.where("vec_id % 20 = 0"), df, 20).collect()]
    ints = {k: [math.floor(64 * x) for x in v] for k, v in vectors.items() if v and all(x is not None and math.isfinite(x) for x in v)}
    expected = []
    for q in (k for k in ints if k % 20 == 0):
        scored = sorted((-sum(a * b for a, b in zip(ints[q], v, strict=False)), k) for k, v in ints.items() if k != q)[:20]
        expected += [(q, i, k, -s) for i, (s, k) in enumerate(scored, 1)]
    assert sorted(got) == sorted(expected)


def test_bounds_hold():
    x = np.random.default_rng(2).standard_normal((50, 64))
    for segments in topk.RESOLUTIONS:
        s = topk.summary(x, segments)
        assert (s @ s.T >= x @ x.T - 1e-9).all()


def rendered_cost(roles, limit=9):
    """Cheapest cost by trying all labels of all turns."""
    best = None
    for labels in itertools.product((1, 2, 3), repeat=len(roles)):
        cost, state, ok = 0, chat.START, True
        for role, label in zip(roles, labels, strict=True):
            cost += 0 if role == chat.ROLES[label - 1] else (chat.RELABEL if role in chat.ROLES else chat.UNKNOWN)
            way = chat.BETWEEN[state, label]
            steps = [len(way) * chat.INSERT] if way is not None else []
            steps += [chat.MERGE] if state == label else []
            if not steps:
                ok = False
                break
            cost, state = cost + min(steps), label
        if ok:
            cost += len(chat.ENDING[state]) * chat.INSERT
            best = cost if best is None else min(best, cost)
    return best


def legal(text):
    roles = re.findall(r"<\|(\w+)\|>\n", text)
    return re.fullmatch(r"s?(ua)*", "".join(x[0] for x in roles)) is not None


@pytest.mark.parametrize("part", [256, 2])
def test_chat_repair(spark, monkeypatch, part):
    monkeypatch.setattr(chat, "PART", part)
    r = random.Random(7)
    convs = {i: [r.choice(["user", "assistant", "system", "bot", None]) for _ in range(r.randint(1, 6))] for i in range(60)}
    rows = [(c, t, role, f"t{t}") for c, roles in convs.items() for t, role in enumerate(roles)]
    rows += [(100, 0, "user", "hi"), (100, 0, "user", "hi"), (100, 1, "assistant", None), (None, None, "user", "lost")]
    got = {}
    for x in sorted(chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect(), key=lambda x: x.part):
        got.setdefault(x.conv_id, []).append(x)
    for c, roles in convs.items():
        text = "".join(x.rendered for x in got[c])
        assert legal(text) and got[c][0].cost == rendered_cost(roles)
        assert sum(chat.MERGE * x.n_merged + chat.INSERT * x.n_inserted for x in got[c]) <= got[c][0].cost
        assert re.findall(r"^t\d$", text, re.M) == [f"t{i}" for i in range(len(roles))]
    assert got[100][0].cost == 0 and got[100][0].n_turns == 2 and legal(got[None][0].rendered)
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_ctw_counts_and_distribution(spark):
    rows = texts(3)
    got = {r.doc_id: r for r in ctw.score(spark.createDataFrame(rows[:-2], DOCS)).collect()}
    train, held = Counter(), 0
    lower = lambda t: (t or "").encode().translate(LOWER).split() + [b"\n"]
    for d, t in rows[:-2]:
        if zlib.crc32(str(d).encode()) % 5 != 1:
            train.update(lower(t))
    n, v = sum(train.values()), len(train)
    for d, t in rows[:-2]:
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(lower(t)), sum(train[w] > 0 for w in lower(t)), n, zlib.crc32(str(d).encode()) % 5 == 1)
        assert math.isclose(r.base_score, sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in lower(t)), rel_tol=1e-9)
        assert r.score < 0
    assert ctw.score(spark.createDataFrame([], DOCS)).count() == 0


def test_ctw_matches_the_recursion():
    """Weighted probabilities of a small tree against the definition, depth by depth."""
    data = np.frombuffer(b"abracadabra abracadabra\n", np.uint8)
    code, count = np.unique(ctw.grams(data, np.array([0, len(data)]), 2), return_counts=True)
    tree = ctw.Tree(code, count, 0, 2)
    for k in range(8):
        at = tree.weigh(k)
        assert np.allclose(at[2].pw, ctw.log_kt(at[2].n0, at[2].n1))
        for d in (1, 0):
            assert at[d].n0.sum() + at[d].n1.sum() == len(data)
            keys = ctw._key(tree.code[d][at[d].first], k).tolist()
            below = Counter()
            for key, pw in zip(ctw._key(ctw._cut(tree.code[d + 1][at[d + 1].first], d), k).tolist(), at[d + 1].pw, strict=True):
                below[key] += pw
            for i, key in enumerate(keys):
                own = ctw.log_kt(at[d].n0[i : i + 1], at[d].n1[i : i + 1])[0]
                assert math.isclose(at[d].pw[i], math.log(0.5) + np.logaddexp(own, below[key]), rel_tol=1e-12)
        n = len(at[0].first)
        ends = tree.mix(at, None, np.zeros(n), np.ones(n)).ends
        assert ((ends > 0) & (ends < 1)).all()
    assert math.isclose(ctw.log_kt(np.array([2.0]), np.array([1.0]))[0], math.log(1 / 16), rel_tol=1e-9)
    assert math.isclose(ctw.log_kt(np.array([90.0]), np.array([1.0]))[0], math.lgamma(90.5) + math.lgamma(1.5) - math.lgamma(92) - math.log(math.pi), rel_tol=1e-9)


def test_ctw_next_bytes_sum_to_one():
    """All 256 bytes after known and unknown contexts, by the functions that answer the query."""
    data = np.frombuffer(b"hello there hello yellow\n" * 3, np.uint8)
    code, count = np.unique(ctw.grams(data, np.array([0, len(data)])), return_counts=True)
    contexts = [code[0], code[5], np.uint64(0x7A7A7A7A7A7A00), np.uint64(0x7A7A7A656C6C00)]
    after = np.concatenate([(c & ~np.uint64(0xFF)) | np.arange(256, dtype=np.uint64) for c in contexts])
    every, into = np.unique(np.concatenate([code, after]), return_inverse=True)
    n = np.bincount(into, np.r_[count, np.zeros(len(after))], len(every)).astype(np.int64)
    table = pa.table({"listed": pa.array([ctw._squeeze(every, n)], pa.binary()), "size": [len(every)]})
    rows = next(ctw._top(iter(ctw._above(table).to_batches())))
    bits = ctw.log2(every, n, ctw.pickle.loads(rows["above"][0].as_py()))
    for c in contexts:
        mine = np.searchsorted(every, (c & ~np.uint64(0xFF)) | np.arange(256, dtype=np.uint64))
        assert math.isclose((2.0 ** bits[mine]).sum(), 1, rel_tol=1e-9)


def test_chat_keeps_equal_turns_without_numbers(spark):
    rows = [(1, None, "user", "ok"), (1, None, "user", "ok"), (None, 0, "user", "hi"), (None, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 0, "user", "hi")]
    got = {x.conv_id: x for x in chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert {c: (x.n_turns, x.rendered.count("ok\n") + x.rendered.count("hi\n")) for c, x in got.items()} == {1: (2, 2), None: (2, 2), 2: (1, 1)}


def ctw_by_definition(train, text):
    """Log10 probability of a byte string: dictionaries of all nodes, weighed by recursion over contexts."""

    def steps(data):
        for i, byte in enumerate(data):
            before = (b"\n" * ctw.DEPTH + data)[i : i + ctw.DEPTH]
            for k in range(8):
                yield [(before[ctw.DEPTH - d :], 1 << k | byte >> (8 - k)) for d in range(ctw.DEPTH + 1)], byte >> (7 - k) & 1

    nodes = {}
    for data in train:
        for path, bit in steps(data):
            for node in path:
                nodes.setdefault(node, [0, 0])[bit] += 1
    own = {x: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi) for x, (a, b) in nodes.items()}
    below, weighed = Counter(), {}
    for x in sorted(nodes, key=lambda x: -len(x[0])):
        weighed[x] = own[x] if len(x[0]) == ctw.DEPTH else math.log(0.5) + np.logaddexp(own[x], below[x])
        below[x[0][1:], x[1]] += weighed[x]

    def log10(data):
        total = 0.0
        for path, bit in steps(data):
            there = [x for x in path if x in nodes]
            p, left = 0.0 if there else 0.5, 1.0
            for x in there:
                kt = (nodes[x][bit] + 0.5) / (sum(nodes[x]) + 1)
                w = 1.0 if x is there[-1] else math.exp(math.log(0.5) + own[x] - weighed[x])
                p, left = p + left * w * kt, left * (1 - w)
            total += math.log10(p)
        return total

    return [log10(x) for x in text]


def test_ctw_scores_with_every_node(spark):
    """Score for score against the definition."""
    r = random.Random(11)
    rows = [(i, "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1000))) for i in range(30)] + [(200, "Ab ab\tab é"), (201, None), (None, "ab ~~ q"), (202, "ab"), (203, "ab")]
    data = {d: b" ".join(split((t or "").lower())) + b"\n" for d, t in rows}
    got = {x.doc_id: x.score for x in ctw.score(spark.createDataFrame(rows, DOCS).repartition(3)).collect()}
    expected = ctw_by_definition([x for d, x in data.items() if d is not None and zlib.crc32(str(d).encode()) % 5 != 1], list(data.values()))
    for d, e in zip(data, expected, strict=True):
        assert math.isclose(got[d], e, rel_tol=1e-9)


def test_ctw_without_training_texts_costs_eight_bits(spark):
    assert ctw.score(spark.createDataFrame([(None, "ab cd")], DOCS)).first().bits_per_byte == 8


def test_quality(spark):
    r = random.Random(8)
    good = lambda: " ".join("".join(r.choice("etaoinshr") for _ in range(r.randint(2, 8))) for _ in range(80)) + "."
    bad = lambda: " ".join("".join(r.choice("ETAOINSHR") for _ in range(r.randint(2, 8))) + "!!" for _ in range(80))
    rows = [(i, good() if i % 3 else bad()) for i in range(400)] + [(1000, None), (1001, ""), (None, good())]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(400)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, DOCS)
    got = {x.doc_id: x for x in quality.report(docs, labels).collect()}
    assert len(got) == len(rows) and all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.3) for x in got.values())
    held = [x for x in got.values() if x.held_out and x.doc_id < 400]
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0) for x in got.values() if x.doc_id is not None)
    assert sum(x.predicted == int(x.doc_id % 3 > 0) for x in held) >= 0.97 * len(held)
    kept = quality.keep_good(docs.select("doc_id", "text", F.lit(1).alias("score"), F.lit("q").alias("__id")), labels)
    assert kept.columns == ["doc_id", "text", "score", "__id"]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {x.score for x in quality.report(docs, none).collect()} == {0.5}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert substring_dedup.window_report(docs).count() == 0
    assert line_dedup.line_report(docs).count() == 0
    assert pii.report(docs).count() == 0
    assert decontaminate.contamination(docs, spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0
    assert quality.report(docs, spark.createDataFrame([], "doc_id long, quality int")).count() == 0
    v = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(v, v).count() == 0


def test_perfect_hash_ends_on_equal_keys():
    keys = np.array([5, 5, 9, 5], dtype=np.uint64)
    h = line_dedup.PerfectHash.build(keys)
    assert h.n == 2 and sorted({int(i) for i in h.index(keys)}) == [0, 1]


def test_lines_with_equal_first_hashes():
    """Three lines share a hash; the fingerprint finds each one's own entry, and only the one that is frequent."""
    rows = pa.table({"shard": [0] * 4, "h": [7, 7, 7, 8], "fp": [1, 2, 3, 1], "docs": [5, 2, 9, 6], "keeper": [10, 20, 30, 40]})
    shard = line_dedup._index(rows)
    probes = pa.table({"shard": [0] * 6, "h": [7, 7, 7, 7, 8, 9], "fp": [3, 2, 1, 4, 1, 1], "block": [1, 2, 3, 4, 5, 6]})
    got = line_dedup._probe(5)(probes, shard).to_pylist()
    assert sorted((x["block"], x["h"], x["fp"], x["keeper"]) for x in got) == [(1, 7, 3, 30), (3, 7, 1, 10), (5, 8, 1, 40)]
    line = "a line that is long enough to be looked at, surely"
    (h, fp), docs = line_dedup._keys(line, 40)[1][0], pa.table({"doc_id": [1, 2], "text": [line, "x"]})
    scalar = lambda x: pa.scalar([x], pa.list_(pa.int64()))
    assert [x[2] for x in line_dedup._kept(docs, scalar(h), scalar(fp), scalar(2), 40)] == [1, 0]
    assert [x[2] for x in line_dedup._kept(docs, scalar(h), scalar(fp + 1), scalar(2), 40)] == [0, 0]


def test_votes_by_definition():
    """Votes against a plain loop, with ties at the last place and equal vectors."""
    r = np.random.default_rng(3)
    sample = r.standard_normal((60, 5)).astype(np.float32)
    sample[40:50] = sample[0]
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    docs, labels = sample[[0, 7, 41]], (np.arange(60) % 3 == 0).astype(float)
    got = quality.vote(docs, sample, labels, 4)
    for d, g in zip(docs, got, strict=True):
        cosine = [round(float(np.float32((d * x).sum())), 6) for x in sample]
        last = sorted(cosine, reverse=True)[3]
        near = [(c, y) for c, y in zip(cosine, labels, strict=True) if c >= last - 1e-6]
        weight = [max((1 + c) / 2, 1e-6) ** quality.SHARPNESS for c, _ in near]
        assert math.isclose(g, sum(w * y for w, (_, y) in zip(weight, near, strict=True)) / sum(weight), rel_tol=1e-4)


def test_latent_directions_by_definition():
    """The basis spans what a full decomposition of the same scaled, centred counts does."""
    r = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    x = quality.features(pa.array([" ".join(r.choices(words[: 10 + i % 30], k=40)) + "!" * (i % 5) for i in range(90)]))
    basis = quality.Basis.fit(x.astype(np.float16), 6)
    counts, rates = x[:, : -quality.RATES].astype(np.float16).astype(float), x[:, -quality.RATES :].astype(np.float16).astype(float)
    y = counts * (np.log((1 + len(x)) / (1 + (counts > 0).sum(axis=0))) + 1)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    y = np.hstack([y, np.clip((rates - rates.mean(axis=0)) / np.maximum(rates.std(axis=0), 1e-6), -4, 4) * 0.15])
    y -= y.mean(axis=0)
    s = np.linalg.svd(y, compute_uv=False)
    kept = np.linalg.norm(y @ basis.v.astype(float)) ** 2
    assert kept >= 0.999 * (s[:6] ** 2).sum()
    assert np.allclose(np.linalg.norm(basis.vectors(x), axis=1), 1, atol=1e-4)


def test_quality_learns_words_of_content(spark):
    """Documents alike in shape, told apart by their words alone; repeated rows score alike and the text of a null counts."""
    r = random.Random(6)
    good, bad = [f"{c}ab" for c in "bcdfghjklm"], [f"{c}ab" for c in "npqrstvwxz"]
    rows = [(i, " ".join(r.choices(good if i % 2 else bad, k=30))) for i in range(300)] + [(400, None), (401, ""), (7, " ".join(good)), (7, " ".join(good))]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(300)] + [(7, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.report(spark.createDataFrame(rows, DOCS), labels).collect()
    assert len(got) == len(rows)
    own = [x for x in got if x.doc_id < 300 and x.held_out]
    assert sum(x.predicted == x.doc_id % 2 for x in own) >= 0.95 * len(own)
    assert len({x.score for x in got if x.doc_id == 7}) <= 2


def test_windows_with_equal_first_hashes():
    a, b = np.array([1, 1, 1, 2, 3, 9], np.uint64), np.array([5, 6, 7, 5, 5, 5], np.uint32)
    got = substring_dedup.members(a, b, np.array([3, 1, 1], np.uint64), np.array([4, 7, 5], np.uint32))
    assert got.tolist() == [True, False, True, False, False, False]
    assert substring_dedup.members(a, b, np.zeros(0, np.uint64), np.zeros(0, np.uint32)).sum() == 0


def test_mixing_passes_columns_of_any_name(spark, monkeypatch):
    """Columns named like the operator's own, and sources dealt by a join instead of a broadcast."""
    r = random.Random(8)
    rows = [(i, " ".join(["w"] * r.choice([1, 7, 60])), r.choice(["a", "a", "b", None]), i, "x", 1, 2, 3, 4, 5) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, u long, g string, tier int, low int, base int, c0 int, _salt int")
    got = {x.doc_id: x for x in mixing.mix_sources(docs).collect()}
    assert len(got) == 400 and all((x.u, x.g, x.tier, x.low, x.base, x.c0, x._salt) == (d, "x", 1, 2, 3, 4, 5) for d, x in got.items())
    monkeypatch.setattr(mixing, "MAX_SOURCES", 0)
    assert {x.doc_id: x for x in mixing.mix_sources(docs).collect()} == got


def test_newton_steps_end_at_the_goal(spark):
    rows = [(1.0, 3.0), (1e12, 1.0), (5.0, 5.0), (7.0, 0.0), (0.0, 2.0), (1e6, 2.9e6)]
    got = spark.createDataFrame(rows, "t double, w double").select("t", "w", mixing.newton(F.col("t"), F.col("w")).alias("r")).collect()
    assert all(math.isclose(x.t * x.r, x.w if x.t else 0, rel_tol=1e-9) for x in got)


def test_top_k_of_a_block_in_several_steps(monkeypatch):
    """Queries in steps of a few, with floors from outside: nothing below a floor, all of the k best that reach it."""
    monkeypatch.setattr(topk, "CELLS", 900)
    r = np.random.default_rng(2)
    c = r.integers(-50, 50, (300, 12)).astype(float)
    qid, cid = np.arange(0, 300, 20), np.arange(300)
    scores = c[qid] @ c.T
    scores[np.arange(len(qid)), qid] = -np.inf
    least = np.sort(scores, axis=1)[:, -5]
    for floor, many in ((None, 7), (least, 5)):
        q, v, s = topk.best(qid, c[qid], cid, c, 7, floor)
        for i, x in enumerate(qid):
            order = np.lexsort((cid, -scores[i]))[:7]
            expected = [(int(j), int(scores[i][j])) for j in order]
            got = sorted(zip(v[q == x].tolist(), s[q == x].tolist(), strict=True), key=lambda p: (-p[1], p[0]))
            assert got == (expected if floor is None else [p for p in expected if p[1] >= floor[i]]) and len(got) >= many


def test_cells_that_no_query_reaches_are_left_out():
    """The bound of a cell is never below a score in it, and far cells fall out."""
    r = np.random.default_rng(5)
    x = np.round(np.concatenate([r.normal(m, 3, (80, 20)) for m in (-40, 0, 40)]))
    stats = topk.summary(x, 4)
    cell = topk.nearest(stats, stats[[0, 90, 200]])
    assert [len(set(cell[i : i + 80])) for i in (0, 80, 160)] == [1, 1, 1]
    low, high = (np.array([f(stats[cell == i], axis=0) for i in range(3)]) for f in (np.min, np.max))
    scores = x @ x.T
    best = np.array([[scores[i][cell == j].max() for j in range(3)] for i in range(len(x))])
    assert topk.reached(stats, low, high, best.min(axis=1)).all()
    for j in range(3):
        assert topk.reached(stats, low, high, best[:, j])[:, j].all()
    assert (~topk.reached(stats, low, high, np.sort(scores, axis=1)[:, -5])).sum() >= 150
