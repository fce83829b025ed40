"""Phrase collocations by suffix automata of shards.

Texts are cut into pieces, and pieces into words. A shard (a block of texts)
builds one generalised suffix automaton over its pieces, for substrings of up to
``LONGEST`` words: its states are the classes of substrings that end at the same
places, the count of a state is the number of those places, and the suffix link
of a state leads to the longest suffix that ends at more of them. States and
links are found by sorting the ends by their words read backwards: the tree of
suffix links is the trie of those reversed words with unary chains drawn
together. Enumerating a state's substrings (longer than its link's, up to its
longest) gives each distinct phrase of the shard once, with its count; Spark
sums them by phrase.

Only phrases that may be frequent are sent. Words, pairs and triples of words are
first counted by a few bits of a hash: a shard sends the slots that it uses with
their counts, packed (sorted, as gaps), and gets a bit for each that says whether
all shards together reach the least count there. Strangers in a slot can only add
to it, so nothing frequent is lost. There are as many slots, and parts of them
that are summed in one task, as the input's size asks for. The automaton then
takes in no rare word, pair or triple, as no frequent phrase holds one, and its
phrases are sent as text, packed by a hash, and summed exactly. A word or phrase
that a third of all rows hold is one entry a shard.

Over the sums the suffix link of a phrase drops its first word, and that of the
mirrored automaton its last. Where the count stays the same along a link both
phrases are in one state (they occur at the same places), and the shorter one is
subsumed. A phrase inside a longer one with the same count is reached by such
links one word at a time, as counts never fall on the way to a part.

Scores, floor(1000 * a * n / (l * r)), are computed in decimals of 38 digits.
Each language's first ``MOST`` are ranked in two rounds, by salt and then over
what those leave, so a language that holds most candidates is in no single task.

Edge cases: a null or empty text has no words; a null language is ``und``, one
with rows of that name. Null and repeated ids are documents like others, and
repeated texts count each. Empty tables give an empty result. Other columns do
not matter. A very long text is a shard of its own. Equal scores are ordered by
count and then by the phrase's bytes, which no two phrases of a language share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlake.llm import blocks
from fundlake.llm.scratch import Scratch
from fundlake.llm.tokens import LOWER, U64, buffers, mix, span_hash

#: Words of a phrase, and occurrences that make it a candidate.
LONGEST, LEAST = 5, 100
#: Phrases reported of each language, and parts in which they are ranked first.
MOST, SALTS = 2000, 64
UNKNOWN = "und"
#: Bytes of text for each slot; about seven words, pairs and triples then share one.
SLOT_BYTES = 16
#: Slots that one task sums at most, and parts that anything is summed in at least (powers of two).
SLOTS, PARTS = 1 << 22, 64
#: Bytes of text whose phrases one task sums, and how much smaller a block is than its text.
PART_BYTES, ZSTD = 64 << 20, 3
#: Bytes between words, and bytes that end a piece.
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, 0x09]] = True
STOP = np.zeros(256, dtype=bool)
STOP[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GRAM = U64(0xD1342543DE82EF95)


class Shard:
    """Words of a block of texts: ids of (language, word) in order, the piece of each, and what the ids stand for."""

    def __init__(self, table: pa.Table):
        data, off = buffers(table["text"])
        data = LOWER[data]
        langs = table["lang"].combine_chunks().fill_null(UNKNOWN).dictionary_encode()
        n = len(data)
        inside = np.zeros(n + 2, dtype=bool)
        inside[1:-1] = ~(BLANK[data] | STOP[data])
        first = np.zeros(n + 1, dtype=bool)
        first[off] = True
        start = np.flatnonzero(inside[1:] & (~inside[:-1] | first))
        end = np.flatnonzero(inside[:-1] & (~inside[1:] | first))
        size = end - start
        offsets = np.zeros(len(start) + 1, np.int64)
        np.cumsum(size, out=offsets[1:])
        text = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data[inside[1:-1]]))
        doc = np.searchsorted(off, start, side="right") - 1
        coded = text.dictionary_encode()
        lang = langs.indices.to_numpy().astype(np.int64)[doc] if len(start) else np.zeros(0, np.int64)
        key, ids = np.unique(lang * max(len(coded.dictionary), 1) + coded.indices.to_numpy(), return_inverse=True)
        self.ids = ids.astype(np.int32)
        #: A new number wherever a piece or a text begins.
        self.piece = np.cumsum(STOP[data], dtype=np.int64)[start] + doc if n else np.zeros(0, np.int64)
        self.words = coded.dictionary.take(pa.array(key % max(len(coded.dictionary), 1)))
        self.langs = langs.dictionary.take(pa.array(key // max(len(coded.dictionary), 1)))

    def counts(self) -> np.ndarray:
        return np.bincount(self.ids, minlength=len(self.words))

    def hashes(self) -> np.ndarray:
        """A hash of each id's language and word, the same in every shard."""
        both = []
        for column in (self.langs, self.words):
            data, off = buffers(column)
            both.append(span_hash(data.astype(U64) + U64(1), off[:-1], off[1:]) if len(off) > 1 else np.zeros(0, U64))
        return mix(both[0] * U64(0x9E3779B97F4A7C15) ^ both[1])

    def grams(self) -> list[np.ndarray]:
        """For 1, 2 and 3 words: the hash of the phrase that ends at each place, the same in every shard."""
        own = self.hashes()[self.ids]
        out = [own]
        for n in (1, 2):
            longer = np.zeros_like(own)
            longer[n:] = mix(out[-1][n - 1 : -1] * _GRAM + own[n:]) if len(own) > n else 0
            out.append(longer)
        return out

    def within(self, n: int) -> np.ndarray:
        """Whether the n words that end at each place stand in one piece."""
        ok = np.zeros(len(self.ids), dtype=bool)
        ok[n - 1 :] = self.piece[n - 1 :] == self.piece[: len(self.piece) - n + 1] if len(ok) >= n else False
        return ok


class Slots:
    """The slots that a shard uses: keys sorted, with their counts."""

    def __init__(self, shard: Shard, bits: int):
        self.shift = U64(64 - bits)
        self.grams, self.ok = shard.grams(), [shard.within(n) for n in (1, 2, 3)]
        levels = [np.unique(g[ok] >> self.shift, return_counts=True) for g, ok in zip(self.grams, self.ok, strict=True)]
        self.keys, at = np.unique(np.concatenate([k for k, _ in levels]), return_inverse=True)
        self.counts = np.bincount(at, weights=np.concatenate([n for _, n in levels]), minlength=len(self.keys)).astype(np.int64)

    def cuts(self, bits: int, parts: int) -> np.ndarray:
        """Where each of so many parts begins among the keys."""
        return np.searchsorted(self.keys, np.arange(parts + 1, dtype=U64) * U64((1 << bits) // parts))

    def reach(self, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many words before each place belong to phrases that may be frequent, by whether each key is; and which words may."""
        seen = lambda level, at: often[np.searchsorted(self.keys, self.grams[level][at] >> self.shift)]
        ok = self.ok
        word = seen(0, ok[0])
        pair = ok[1].copy()
        pair[1:] &= word[1:] & word[:-1]
        pair[pair] = seen(1, pair)
        triple = ok[2].copy()
        triple[1:] &= pair[1:] & pair[:-1]
        triple[triple] = seen(2, triple)
        at = np.arange(len(pair))
        run = at - np.maximum.accumulate(np.where(triple, 0, at)) if len(at) else at  # triples in a row that end here
        return np.where(triple, run + 1, pair.astype(np.int64)), word


def packed(values: list[np.ndarray]) -> bytes:
    """Arrays of numbers below 2**32, compressed byte by byte: most have only low ones."""
    planes = b"".join(v.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for v in values)
    return pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(payload: bytes, n: int, arrays: int) -> list[np.ndarray]:
    planes = np.frombuffer(pa.decompress(payload, decompressed_size=4 * n * arrays, codec="zstd", asbytes=True), np.uint8)
    return [np.ascontiguousarray(p.reshape(4, n).T).view("<u4").ravel() for p in np.split(planes, arrays)]


class Automaton:
    """States of the suffix automaton of the substrings of ids of up to depth words that reach allows.

    places: ends in the order of their reversed words. Of state s, ends are
    places[first[s] : first[s] + count[s]]; its substrings have more than
    least[s] words and up to most[s]; link[s] is its suffix link, -1 for the
    empty string."""

    def __init__(self, ids: np.ndarray, reach: np.ndarray, depth: int = LONGEST):
        """reach: how many words before each place may belong to a substring that ends there."""
        inside = np.flatnonzero((reach > 0) | (np.append(reach[1:], 0) > 0))  # words on their own make no phrase
        columns = [np.where(reach[inside] >= d, ids[np.maximum(inside - d, 0)], np.int32(-1)) for d in range(depth)]
        order = np.lexsort(columns[::-1])
        self.places = inside[order]
        n = len(order)
        new = np.zeros(n, dtype=bool)
        new[:1] = True
        firsts, counts, mosts, links, held = [], [], [], [], np.full(n, -1)
        for d, column in enumerate(columns):
            column = column[order]
            new[1:] |= column[1:] != column[:-1]
            begin = np.flatnonzero(new)
            size = np.diff(np.append(begin, n))
            begin, size = begin[column[begin] >= 0], size[column[begin] >= 0]
            # Substrings that end where those shorter by a word do are of their state; the others begin one, linked to it.
            parent = held[begin]
            known = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            same = parent >= 0
            same[same] = known[parent[same]] == size[same]
            lengths = np.concatenate(mosts) if mosts else np.zeros(0, np.int64)
            lengths[parent[same]] = d + 1
            mosts = [lengths, np.full((~same).sum(), d + 1)]
            fresh = len(known) + np.arange((~same).sum())
            state = parent.copy()
            state[~same] = fresh
            firsts.append(begin[~same])
            counts.append(size[~same])
            links.append(parent[~same])
            step = np.zeros(n + 1, np.int64)  # each state's number over the ends that it has, -1 where a run is too short
            np.add.at(step, begin, state + 1)
            np.add.at(step, begin + size, -(state + 1))
            held = np.cumsum(step[:n]) - 1
        self.first, self.count, self.most, self.link = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (firsts, counts, mosts, links))
        self.least = np.where(self.link >= 0, self.most[self.link], 0)

    def substrings(self, shortest: int = 2) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, one end of each, count) of all distinct substrings."""
        for n in range(shortest, int(self.most.max(initial=0)) + 1):
            s = np.flatnonzero((self.least < n) & (n <= self.most))
            yield n, self.places[self.first[s]], self.count[s]


def _ask(blocks_: DataFrame, bits: int, parts: int) -> DataFrame:
    """(part, block, n, payload): the slots of each block that a part sums, as gaps, and their counts."""

    def run(block: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
        slots = Slots(Shard(table), bits)
        cuts = slots.cuts(bits, parts)
        rows = []
        for part in np.flatnonzero(np.diff(cuts)).tolist():
            keys = slots.keys[cuts[part] : cuts[part + 1]] - U64(part * ((1 << bits) // parts))
            rows.append((part, len(keys), packed([np.diff(keys, prepend=U64(0)), np.minimum(slots.counts[cuts[part] : cuts[part + 1]], (1 << 32) - 1)])))
        part, n, payload = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array([block] * len(rows), pa.int64()), pa.array(n, pa.int32()), pa.array(payload, pa.binary())], names=["part", "block", "n", "payload"])

    return blocks.each(blocks_, run, "part int, block long, n int, payload binary")


def _answer(asked: DataFrame, bits: int, parts: int, least: int) -> DataFrame:
    """(block, part, often): a bit for each slot that a block asked for; a part's counters are one array."""

    def run(rows: pa.Table) -> pa.Table:
        sums = np.zeros((1 << bits) // parts, np.int64)
        sent = list(zip(rows["payload"].to_pylist(), rows["n"].to_pylist(), strict=True))
        for payload, n in sent:
            gaps, counts = unpacked(payload, n, 2)
            sums[np.cumsum(gaps, dtype=np.int64)] += counts
        often = sums >= least
        bits_of = [pa.compress(np.packbits(often[np.cumsum(unpacked(payload, n, 2)[0], dtype=np.int64)]).tobytes(), codec="zstd", asbytes=True) for payload, n in sent]
        del sums, often
        blocks.trim()
        return pa.table([rows["block"], rows["part"], pa.array(bits_of, pa.binary())], names=["block", "part", "often"])

    return asked.groupBy("part").applyInArrow(run, "block long, part int, often binary")


def _often(slots: Slots, bits: int, parts: int, part: pa.ListScalar, often: pa.ListScalar) -> np.ndarray:
    """Which of a shard's keys are frequent, by the answers to it."""
    cuts, out = slots.cuts(bits, parts), np.zeros(len(slots.keys), dtype=bool)
    for p, answer in zip(part.as_py() or (), often.as_py() or (), strict=True):
        n = int(cuts[p + 1] - cuts[p])
        out[cuts[p] : cuts[p + 1]] = np.unpackbits(np.frombuffer(pa.decompress(answer, decompressed_size=-(-n // 8), codec="zstd", asbytes=True), np.uint8), count=n)
    return out


def _phrases(answered: DataFrame, bits: int, parts: int, longest: int, own: int) -> DataFrame:
    """(part, payload): each block's phrases of 1 to longest words that may be frequent, with their counts, as tables dealt by a hash.

    Phrases of 0 words stand for all words of a language."""

    def run(block: int, table: pa.Table, part: pa.ListScalar, often: pa.ListScalar) -> Iterator[pa.RecordBatch]:
        shard = Shard(table)
        slots = Slots(shard, bits)
        reach, word = slots.reach(_often(slots, bits, parts, part, often))
        hashes, ids = shard.hashes(), np.flatnonzero(np.bincount(shard.ids[word], minlength=len(shard.words)))
        text = lambda n, ids, phrase, count: (pa.array(np.full(len(ids), n)), shard.langs.take(pa.array(ids)), phrase, pa.array(count))
        columns, dealt = [text(1, ids, shard.words.take(pa.array(ids)), shard.counts()[ids])], [hashes[ids]]
        for n, ends, count in Automaton(shard.ids, np.minimum(reach, longest - 1), longest).substrings():
            words = [shard.ids[ends - d] for d in range(n - 1, -1, -1)]
            columns.append(text(n, words[-1], pc.binary_join_element_wise(*[shard.words.take(pa.array(w)) for w in words], pa.scalar(" ", pa.large_string())), count))
            h = hashes[words[0]]
            for w in words[1:]:
                h = mix(h * _GRAM + hashes[w])
            dealt.append(h)
        some = pa.concat_tables([pa.table(c, names=["words", "lang", "phrase", "a"]) for c in columns])
        of = (np.concatenate(dealt) % U64(own)).astype(np.int64)
        order = np.argsort(of, kind="stable")
        some, cuts = some.take(pa.array(order)), np.searchsorted(of[order], np.arange(own + 1))
        full = np.flatnonzero(np.diff(cuts)).tolist()
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([blocks.encode(some.slice(cuts[p], cuts[p + 1] - cuts[p])) for p in full], pa.binary())], names=["part", "payload"])
        langs, of_lang = np.unique(shard.langs.to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
        totals = np.bincount(of_lang, weights=shard.counts(), minlength=len(langs)).astype(np.int64)
        if len(langs):
            whole = pa.table([pa.array(np.zeros(len(langs), np.int64)), pa.array(langs.tolist(), pa.large_string()), pa.array([""] * len(langs), pa.large_string()), pa.array(totals)], names=["words", "lang", "phrase", "a"])
            yield pa.RecordBatch.from_arrays([pa.array([block % own], pa.int32()), pa.array([blocks.encode(whole)], pa.binary())], names=["part", "payload"])

    return blocks.each(answered, run, "part int, payload binary")


def _summed(sent: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, words, a) of phrases that reach the least count, and of all words of each language (a row for each part)."""

    def run(rows: pa.Table) -> pa.Table:
        tables = [blocks.decode(x.as_buffer()) for x in rows["payload"]]
        every = pa.concat_tables([t.set_column(1, "lang", t["lang"].cast(pa.large_string())) for t in tables])
        sums = every.group_by(["lang", "phrase", "words"]).aggregate([("a", "sum")])
        sums = sums.filter(pc.or_(pc.greater_equal(sums["a_sum"], least), pc.equal(sums["words"], 0)))
        del tables, every
        blocks.trim()
        return pa.table([sums["lang"].cast(pa.string()), sums["phrase"].cast(pa.string()), sums["words"], sums["a_sum"]], names=["lang", "phrase", "words", "a"])

    return sent.groupBy("part").applyInArrow(run, "lang string, phrase string, words long, a long")


def frequent(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, scope: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, a) of all phrases of 1 to longest words that occur at least least times, and (lang, n) of all words; docs: lang, text."""
    work = Scratch(docs.sparkSession, scope)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), "text").where(F.length("text") > 0)
    kept = blocks.store(texts, work, "phrases-blocks")
    size = (kept.agg(F.sum(F.length("payload"))).first()[0] or 0) * ZSTD
    bits = max((size // SLOT_BYTES).bit_length(), PARTS.bit_length())
    parts = max((1 << bits) // SLOTS, PARTS)
    answers = work.keep(_answer(_ask(kept, bits, parts), bits, parts, least), "phrases-answers")
    sent = _phrases(blocks.reply(kept, answers, part="part", often="often"), bits, parts, longest, max(size // PART_BYTES, PARTS))
    found = work.keep(_summed(sent, least), "phrases")
    work.drop(kept, answers)
    return found.where("words > 0"), found.where("words = 0").groupBy("lang").agg(F.sum("a").alias("n"))


def subsumed(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, a) of those that a phrase longer by a word has inside it, as often: links along which the count stays the same."""
    longer = phrases.where("words > 2")
    links = F.array(F.regexp_replace("phrase", "^[^ ]+ ", ""), F.regexp_replace("phrase", " [^ ]+$", ""))
    return longer.select("lang", F.explode(links).alias("phrase"), "a")


def scored(candidates: DataFrame, phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) by each candidate's lowest cut."""
    word = F.split("phrase", " ")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), (F.col("words") - 1).cast("int"))))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice(word, F.lit(1), F.col("k")), " ").alias("head"), F.array_join(F.slice(word, F.col("k") + 1, F.lit(LONGEST)), " ").alias("tail"))
    part = lambda name, count: phrases.select("lang", F.col("phrase").alias(name), F.col("a").alias(count))
    whole = cuts.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"]).join(totals, "lang")
    big = lambda c: F.col(c).cast("decimal(19,0)")
    up = F.lit(1000).cast("decimal(4,0)") * F.col("a").cast("decimal(15,0)") * big("n")
    score = whole.withColumn("up", up).withColumn("down", big("l") * big("r")).withColumn("score", F.expr("up div down"))
    low = score.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("x"))
    return low.select("lang", "phrase", "x.a", "x.l", "x.r", "x.n", "x.score")


def ranked(scores: DataFrame, most: int = MOST) -> DataFrame:
    """Each language's first: by score and count, highest first, and then by phrase."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = scores.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("rank") <= most)
    full = some.drop("_salt").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return full.where(F.col("rank") <= most).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, least: int = LEAST, most: int = MOST, scope: str | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's phrases of 2 to 5 words that hold together most."""
    phrases, totals = frequent(docs, least, LONGEST, scope)
    candidates = phrases.where("words > 1").join(subsumed(phrases), ["lang", "phrase", "a"], "left_anti")
    return ranked(scored(candidates, phrases, totals), most)
