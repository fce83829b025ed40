"""MinHash near-dedup by an inverted join on signature coordinates.

A document's set is its distinct word shingles. Documents with equal sets form
a class; everything below works on classes, so exact copies meet only once.

A class is named by two 64-bit hashes of its set; where sets share the first,
the second names them.

1. A class's signature has ``COORDINATES`` minima. It is posted under its
   coordinate-value pairs. A pair of classes with a Jaccard similarity of the
   threshold agrees on about 3/4 of the coordinates; those that agree on at
   least ``MATCHES`` (chance of missing one at 0.75: below 1e-4) are candidates.
2. Prefix: in one order of all pairs (rarest first) two such classes share a
   pair among the first ``COORDINATES - MATCHES + 1`` of each, so only these are
   posted, and pairs that one class alone has take up the first places. Common
   passages so drop out of nearly all postings.
3. In a posting list, collisions are counted between signatures; classes that
   are linked already are skipped, and a list yields a spanning forest, not its
   pairs. A list too long for that ties its members to its first one, uncounted.
4. The components of these ties are candidate clusters. Links are then confirmed
   on full sets within each cluster: a class is tested against all others at
   once, beginning outside the largest component so far, until all untested
   classes are in one component. A large cluster is dealt to parts; the classes
   with most links in three of the parts are sent to all parts, and whatever that
   leaves outside the largest component is sent to all parts too. So every link that could join two
   components is tested, and none within one needs to be.

Rules (``near_groups``): A-Z is lower-cased, words are parted by ASCII white
space. The set of a text of fewer words than a shingle is its whole sequence as
one; a text without words has an empty set and is linked with nothing. Two
documents are linked if 100 * intersection >= 75 * union.

Edge cases: null texts have no words. Rows with equal texts are one class, and
their component is named by the smallest id among them; rows that share an id
but not a text stay apart but for that name. A null doc_id names no component:
a component of such rows has a null name and keeps all of them. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.llm import blocks as B
from fundlake.llm.components import components, spread_join
from fundlake.llm.scratch import Scratch
from fundlake.llm.tokens import U64, mix, span_hash, words_of

SHINGLE, PERCENT = 5, 75
COORDINATES, MATCHES = 64, 34
#: Longest posting list whose collisions are counted one by one.
LIST = 64
#: Classes, and set elements, of one part of a cluster.
PART, PART_ELEMENTS = 256, 1 << 21
_I64 = np.int64
_FACTORS = mix(np.arange(1, COORDINATES + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)


def shingle_sets(column: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all documents, ascending within each, and where each document's begin."""
    words = words_of(column, lower=True)
    h, off = words.hashes(), words.off
    count = np.diff(off)
    have = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    doc = np.repeat(np.arange(len(have)), have)
    start = np.arange(int(have.sum())) - (np.cumsum(have) - have)[doc] + off[:-1][doc]
    s = span_hash(h, start, np.minimum(start + n, off[1:][doc]))
    order = np.lexsort((s, doc))
    s, doc = s[order], doc[order]
    new = np.r_[True, (s[1:] != s[:-1]) | (doc[1:] != doc[:-1])] if len(s) else np.zeros(0, bool)
    s, doc = s[new], doc[new]
    return s, np.searchsorted(doc, np.arange(len(have) + 1))


def signatures(s: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of minima for each non-empty set."""
    full = np.flatnonzero(np.diff(off))
    out = np.empty((len(full), COORDINATES), dtype=np.uint32)
    at = off[:-1][full]
    for c, factor in enumerate(_FACTORS):
        if len(full):
            out[:, c] = np.minimum.reduceat(((s * factor) >> U64(32)).astype(np.uint32), at)
    return out


def _describe(shingle: int):
    def run(block: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
        s, off = shingle_sets(table["text"], shingle)
        size = np.diff(off)
        full = np.flatnonzero(size)
        cls, twin = np.zeros(len(size), dtype=U64), np.zeros(len(size), dtype=U64)
        for names, salt in ((cls, 0xC2B2AE3D27D4EB4F), (twin, 0x165667B19E3779F9)) if len(full) else ():  # sums of re-hashed elements name a set
            names[full] = mix(np.add.reduceat(mix(s ^ U64(salt)), off[:-1][full]) + size[full].astype(U64))
        sig = iter(signatures(s, off))
        signed = [next(sig).tobytes() if n else None for n in size.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(size), block)), pa.array(np.arange(len(size))), table["doc_id"].combine_chunks(), pa.array(size.astype(_I64)), pa.array(cls.view(_I64)), pa.array(twin.view(_I64)), pa.array(signed, pa.binary())], names=["block", "row", "doc_id", "size", "cls", "twin", "sig"])

    return run


def told_apart(rows: DataFrame) -> DataFrame:
    """rows with a class for each (cls, twin): sets that share the first name but not the second go by the second."""
    shared = rows.where("size > 0").groupBy("cls").agg(F.min("twin").alias("a"), F.max("twin").alias("b")).where("a <> b").select("cls", F.lit(True).alias("shared"))
    if shared.limit(1).count() == 0:
        return rows.drop("twin")
    return rows.join(shared, "cls", "left").withColumn("cls", F.when(F.col("shared"), F.col("twin")).otherwise(F.col("cls"))).drop("shared", "twin")


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return int(i)

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j

    def roots(self) -> np.ndarray:
        return np.array([self.find(i) for i in range(len(self.up))], dtype=_I64)


def _count_collisions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of each posting list's pairs that agree on enough coordinates."""
    for batch in batches:
        a, b = [], []
        for row in batch["posted"].to_pylist():
            cls = [x["cls"] for x in row]
            sig = np.frombuffer(b"".join(x["sig"] for x in row), np.uint32).reshape(len(row), -1)
            forest = Forest(len(row))
            for i in range(1, len(row)):
                for j in np.flatnonzero((sig[:i] == sig[i]).sum(axis=1) >= MATCHES).tolist():
                    if forest.join(i, j):
                        a.append(min(cls[i], cls[j]))
                        b.append(max(cls[i], cls[j]))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _candidates(classes: DataFrame, work: Scratch) -> DataFrame:
    """Ties (a, b) between classes whose components hold all pairs that agree on enough coordinates."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mix(np.arange(COORDINATES, dtype=U64) + U64(0x1234567))
        for batch in batches:
            sig = np.frombuffer(b"".join(batch["sig"].to_pylist()), np.uint32).reshape(batch.num_rows, COORDINATES)
            item = mix(sig.astype(U64) * U64(0x9FB21C651E98DF25) ^ salt)
            yield pa.RecordBatch.from_arrays([pa.array(item.ravel().view(_I64)), pa.array(np.repeat(batch["cls"].to_numpy(), COORDINATES))], names=["item", "cls"])

    items = classes.select("cls", "sig").mapInArrow(pairs, "item long, cls long")
    shared = items.groupBy("item").agg(F.count("*").alias("df")).where("df > 1")
    ranked = items.join(shared, "item").groupBy("cls").agg(F.array_sort(F.collect_list(F.struct("df", "item"))).alias("items"))
    # Pairs that a class alone has come first in the order; what is left of its prefix is posted.
    alone = COORDINATES - F.size("items")
    prefix = F.slice("items", 1, F.greatest(COORDINATES - MATCHES + 1 - alone, F.lit(0)))
    posted = work.keep(ranked.where(F.size("items") >= MATCHES).select("cls", F.explode(prefix).alias("x")).select("cls", "x.item", "x.df"), "postings")
    short = posted.where(F.col("df") <= LIST).join(classes.select("cls", "sig"), "cls")
    counted = short.groupBy("item").agg(F.collect_list(F.struct("cls", "sig")).alias("posted")).where(F.size("posted") > 1).select("posted").mapInArrow(_count_collisions, "a long, b long")
    long = posted.where(F.col("df") > LIST)
    first = long.groupBy("item").agg(F.min("cls").alias("a"))
    # A class is tied to the least of its lists' first members, and those to it: few ties, as many classes share their lists.
    firsts = long.join(first, "item").groupBy("cls").agg(F.array_sort(F.collect_set("a")).alias("firsts"))
    tied = firsts.select(F.explode(F.array_append("firsts", F.col("cls"))).alias("b"), F.col("firsts")[0].alias("a")).where("a <> b").select("a", "b")
    return counted.union(tied).distinct()


def _similar(sets: list[np.ndarray], size: np.ndarray, flat: np.ndarray, owner: np.ndarray, one: np.ndarray, percent: int) -> np.ndarray:
    """Which of the sets (flat, with owner) are linked with one."""
    at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    both = np.bincount(owner[one[at] == flat], minlength=len(sets))
    return 100 * both >= percent * (size + len(one) - both)


def _set(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, U64)


def _within(percent: int):
    """Links of each part: (cls, peer) spanning its components, and how many classes the component has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, int, bool]] = []
            for cluster, part, rows in zip(batch["cluster"].to_pylist(), batch["part"].to_pylist(), batch["members"].to_pylist(), strict=True):
                rows.sort(key=lambda x: x["cls"])
                sets = [_set(x["shingles"]) for x in rows]
                size = np.array([len(x) for x in sets])
                flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
                forest, open_, best, links = Forest(len(sets)), np.ones(len(sets), bool), 0, -1
                while len(sets) > 1 and open_.any():
                    root = forest.roots()
                    left = np.flatnonzero(open_)
                    if (root[left] == root[left[0]]).all():
                        break
                    largest = np.bincount(root).argmax()
                    outside = left[root[left] != largest]
                    i = int(outside[0] if len(outside) else left[0])
                    open_[i] = False
                    near = np.flatnonzero(_similar(sets, size, flat, owner, sets[i], percent))
                    if len(near) > links:
                        links, best = len(near), i
                    for j in near.tolist():
                        forest.join(i, j)
                root = forest.roots()
                out += [(cluster, part, rows[i]["cls"], rows[int(root[i])]["cls"], i == best) for i in range(len(rows))]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()))], names=["cluster", "part", "cls", "peer", "centre"])

    return run


def _across(percent: int):
    """Links (a, b) between the components (labels) so far that spans what visiting classes tie together in a part.

    Guests: the visitors with their sets, and without sets the part's members with their labels."""

    def run(members: pa.Table, guests: pa.Table) -> pa.Table:
        a, b = [], []
        visitors = guests.filter(guests["shingles"].is_valid())
        if members.num_rows and visitors.num_rows:
            sets = [_set(x.as_buffer()) for x in members["shingles"]]
            size = np.array([len(x) for x in sets])
            flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
            labels, number = np.unique(guests["label"].to_numpy(), return_inverse=True)
            own = guests["shingles"].is_null().to_numpy()
            cls, of = guests["cls"].to_numpy()[own], number[own]
            order = np.argsort(cls)
            of = of[order][np.searchsorted(cls[order], members["cls"].to_numpy())]
            forest = Forest(len(labels))
            for i, raw in zip(number[~own].tolist(), visitors["shingles"], strict=True):
                for j in np.unique(of[_similar(sets, size, flat, owner, _set(raw.as_buffer()), percent)]).tolist():
                    if forest.join(i, j):
                        a.append(labels[i])
                        b.append(labels[j])
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _confirmed(sets: DataFrame, percent: int, work: Scratch) -> DataFrame:
    """Links (a, b) between classes that span the components of the true links; sets: (cluster, part, parts, cls, shingles)."""
    gathered = sets.groupBy("cluster", "part").agg(F.collect_list(F.struct("cls", "shingles")).alias("members"))
    local = work.keep(gathered.mapInArrow(_within(percent), "cluster long, part int, cls long, peer long, centre boolean"), "links")
    links = local.where("cls <> peer").select(F.col("peer").alias("a"), F.col("cls").alias("b"))
    dealt = sets.where("parts > 1")
    if dealt.limit(1).count() == 0:
        return links
    members = dealt.select("cluster", "part", "cls", "shingles")
    placed = dealt.select("cluster", "part", "cls")

    def visit(chosen: DataFrame, labels: DataFrame) -> DataFrame:
        """What some classes tie together in all parts of their clusters; labels: (cls, label) of all dealt classes."""
        labelled = placed.join(labels, "cls").select("cluster", "part", "cls", "label", F.lit(None).cast("binary").alias("shingles"))
        going = dealt.join(chosen.select("cls"), "cls", "left_semi").join(labels, "cls").select("cluster", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "cls", "label", "shingles")
        guests = work.keep(labelled.unionByName(going), "visitors")
        met = members.groupBy("cluster", "part").cogroup(guests.groupBy("cluster", "part")).applyInArrow(_across(percent), "a long, b long")
        return work.keep(met.distinct(), "visits")

    centres = local.where("centre").groupBy("cluster").agg(F.array(F.min("cls"), F.max("cls"), F.min_by("cls", F.xxhash64("cls"))).alias("c"))
    first = visit(centres.select(F.explode("c").alias("cls")).distinct(), local.select("cls", F.col("peer").alias("label")))
    found = components(links.union(first), work).withColumnsRenamed({"node": "cls"})
    now = placed.join(found, "cls", "left").select("cluster", "cls", F.coalesce("label", "cls").alias("label"))
    sizes = now.groupBy("cluster", "label").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("cluster").agg(F.max(F.struct("n", "label")).alias("x")).select("cluster", F.col("x.label").alias("largest"))
    rest = work.keep(now.join(largest, "cluster").where("label <> largest").select("cls"), "outside")
    return links.union(first).union(visit(rest, now.select("cls", "label")))


def near_groups(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, scope: str | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each document, and its row in the packed input (block, row)."""
    work = Scratch(docs.sparkSession, scope)
    packed = B.store(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), work, "near-blocks")
    return _groups(packed, shingle, percent, work).select("doc_id", F.col("size").alias("n_shingles"), "component_id", "kept")


def _groups(packed: DataFrame, shingle: int, percent: int, work: Scratch) -> DataFrame:
    rows = told_apart(work.keep(B.each(packed, _describe(shingle), "block long, row long, doc_id long, size long, cls long, twin long, sig binary"), "signatures"))
    classes = work.keep(rows.where("size > 0").groupBy("cls").agg(F.max("sig").alias("sig"), F.max("size").alias("size"), F.min(F.struct("block", "row")).alias("at")), "classes")
    ties = work.keep(_candidates(classes, work), "ties")
    clusters = components(ties, work).withColumnsRenamed({"node": "cls", "label": "cluster"})
    members = classes.select("cls", "size", "at").join(clusters, "cls")
    parts = members.groupBy("cluster").agg(F.greatest(F.ceil(F.count("*") / PART), F.ceil(F.sum("size") / PART_ELEMENTS)).cast("int").alias("parts"))
    placed = members.join(parts, "cluster").select(F.col("at.block").alias("block"), F.struct(F.col("at.row").alias("row"), "cls", "cluster", "parts", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int").alias("part")).alias("x"))

    def take(block: int, table: pa.Table, wanted: pa.Scalar) -> Iterator[pa.RecordBatch]:
        want = wanted.as_py() or []
        s, off = shingle_sets(table["text"].take(pa.array([x["row"] for x in want], pa.int64())), shingle)
        raw = [s[a:b].tobytes() for a, b in zip(off[:-1], off[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([*[pa.array([x[k] for x in want], t) for k, t in (("cluster", pa.int64()), ("part", pa.int32()), ("parts", pa.int32()), ("cls", pa.int64()))], pa.array(raw, pa.binary())], names=["cluster", "part", "parts", "cls", "shingles"])

    sets = work.keep(B.each(B.reply(packed, placed, wanted="x").where("wanted IS NOT NULL"), take, "cluster long, part int, parts int, cls long, shingles binary"), "sets")
    links = work.keep(_confirmed(sets, percent, work), "confirmed")
    found = components(links, work).withColumnsRenamed({"node": "cls", "label": "component"})
    n = rows.count()
    named = work.keep(spread_join(rows.drop("sig"), found, "cls", n).withColumn("component", F.coalesce("component", "cls")), "named")
    names = named.where("size > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    full = spread_join(named, names, "component", n)
    component_id = F.when(F.col("size") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return full.select("block", "row", "doc_id", "size", "component", component_id.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, scope: str | None = None) -> DataFrame:
    """docs with one row of each group: that with the smallest id, of equal ones the first; rows without words all stay."""
    work = Scratch(docs.sparkSession, scope)
    packed = B.store(docs, work, "near-blocks")
    rows = _groups(packed, shingle, percent, work)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "block", "row"))
    stay = rows.where("size > 0").groupBy("component").agg(first.alias("x")).select("x.block", "x.row").union(rows.where("size = 0").select("block", "row"))

    def run(block: int, table: pa.Table, row: pa.Scalar) -> Iterator[pa.RecordBatch]:
        if row.is_valid:
            yield from table.take(pa.array(sorted(row.as_py()), pa.int64())).combine_chunks().to_batches()

    return B.each(B.reply(packed, stay, row="row"), run, docs.schema)
