"""Very long texts, clashing column names, ties, repeated rows, null ids and empty tables."""

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fundlake.llm import chat, ctw, decontaminate, line_dedup, mixing, near_dedup, pii, quality, substring_dedup

DOCS = "doc_id long, text string"
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


@pytest.fixture(scope="module")
def long_text():
    r = random.Random(12)
    words = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 9))) for _ in range(300_000)]
    return " ".join(w + ("\n" if i % 12 == 11 else "") for i, w in enumerate(words))


@pytest.fixture(scope="module")
def docs(spark, long_text):
    passage = " ".join(long_text.split()[200_000:200_060])
    line = "a line that six documents have in common, all of it"
    rows = [(1, long_text + "\n" + line), (2, "x " + passage + " y"), (None, None), (4, "")] + [(10 + i, f"short {i}\n{line}") for i in range(5)]
    return spark.createDataFrame(rows, DOCS).cache()


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_long_text_substrings(docs, long_text):
    got = by_id(substring_dedup.window_report(docs))
    words = long_text.split() + "a line that six documents have in common, all of it".split()
    assert (got[1].n_words, got[1].n_removed) == (len(words), 60)
    assert got[1].kept_sha256 == sha(" ".join(words[:200_000] + words[200_060:])) and got[2].kept_sha256 == sha("x y")


def test_long_text_scores(docs, long_text):
    got = by_id(ctw.score(docs))
    assert got[1].n_tokens == len(long_text.split()) + 11 + 1 and math.isfinite(got[1].score) and 0 < got[1].bits_per_byte < 8


def test_long_text_benchmark(spark, docs, long_text):
    items = spark.createDataFrame([(1, " ".join(long_text.split()[250_000:250_030])), (2, long_text)], "item_id long, text string")
    got = by_id(decontaminate.contamination(docs, items))
    assert got[1].n_hit == len(long_text.split()) and got[1].n_items == 2 and got[2].n_hit == 60 and got[None].n_words == 0


def test_long_text_lines(docs, long_text):
    got = by_id(line_dedup.line_report(docs))
    assert got[1].n_lines == (long_text + "\n").count("\n") + 1 and got[1].n_dropped == 1 and got[14].n_dropped == 0
    assert got[1].kept_sha256 == sha(long_text)


def test_long_text_quality(spark, docs):
    labels = spark.createDataFrame([(i, i % 2) for i in (1, 2, 10, 11, 12, 13)], "doc_id long, quality int")
    got = by_id(quality.report(docs, labels))
    assert len(got) == 9 and all(0 <= x.score <= 1 for x in got.values())


def test_long_conversations(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", "t" * (400_000 if i == 3 else 3)) for i in range(2000)]
    got = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("part").collect()
    assert sum(x.n_turns for x in got) == 2000 and {x.cost for x in got} == {0}
    assert "".join(x.rendered for x in got) == "".join(f"<|{role}|>\n{text}\n" for _, _, role, text in rows)


def test_many_rows_of_one_turn_are_cut(spark):
    rows = [(1, None, "user", f"t{i:05d}") for i in range(2500)] + [(1, 7, "system", f"s{i:05d}") for i in range(1500)]
    got = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("part").collect()
    assert [x.part for x in got] == [0, 1, 2, 3, 4] and [x.n_turns for x in got] == [1024, 476, 1024, 1024, 452]
    said = [x for x in "".join(x.rendered for x in got).split("\n") if x and not x.startswith("<|")]
    assert said == [f"s{i:05d}" for i in range(1500)] + [f"t{i:05d}" for i in range(2500)]


def test_chat_ties_prefer_the_first_role_from_the_end(spark):
    """An unknown role alone may be a user's or an assistant's; both repairs cost alike, and the last turn is the user's if so."""
    rows = [(1, 0, "robot", "a", "x"), (2, 0, None, "b", "y")]
    got = {x.conv_id: x for x in chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string")).collect()}
    for x in got.values():
        # As a user's: relabelled and an answer put in. As an assistant's: a question put in before.
        assert (x.cost, x.n_relabeled, x.n_inserted, x.n_out) == (chat.UNKNOWN + chat.INSERT, 1, 1, 2)
    assert got[1].rendered == "<|user|>\na\n<|assistant|>\n\n"


def test_lm_rows_without_id_are_neither_learnt_nor_held_out(spark):
    rows = [(i, f"word{i % 4} other") for i in range(20)] + [(None, "word1 never"), (None, "word1 never")]
    got = ctw.score(spark.createDataFrame([(*r, "extra", 1) for r in rows], DOCS + ", block string, learn int")).collect()
    none = [x for x in got if x.doc_id is None]
    learnt = [i for i in range(20) if zlib.crc32(str(i).encode()) % 5 != 1]
    assert len(none) == 2 and none[0].score == none[1].score and not none[0].held_out
    assert none[0].train_tokens == 3 * len(learnt) and none[0].n_known == 2


def test_columns_of_any_name_pass(spark):
    rows = [(i, f"the same line of forty characters and more, yes\nown {i}", "s", 1, 2, 3, "p") for i in range(6)]
    docs = spark.createDataFrame(rows, DOCS + ", source string, block int, h int, keeper int, payload string")
    kept = line_dedup.dedup_lines(docs)
    assert kept.columns == docs.columns and {r.payload for r in kept.collect()} == {"p"}
    assert near_dedup.keep_one(docs).columns == docs.columns
    assert substring_dedup.remove_repeats(docs).count() == 6


def test_repeated_rows_get_equal_answers(spark):
    rows = [(1, "mail a@b.cd"), (1, "mail a@b.cd"), (1, "other"), (None, "a@b.cd")]
    got = pii.report(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(x.n_email for x in got) == [0, 1, 1, 1]
    labels = spark.createDataFrame([(1, 1), (1, 0), (7, 1)], "doc_id long, quality int")
    same = [x.score for x in quality.report(spark.createDataFrame(rows, DOCS), labels).collect()]
    assert len(same) == 4 and sorted(same)[0] >= 0


def test_pipeline_of_empty_tables(spark, tmp_path):
    where = f"file://{tmp_path}"
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    assert corpus_pipeline.run(spark, where).count() == 0


def test_mix_of_equal_sizes_takes_near_the_target(spark):
    rows = [(i, "a b c", "s" if i % 3 else None) for i in range(300)]
    got = mixing.mix_sources(spark.createDataFrame(rows, DOCS + ", source string")).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect()
    assert all(abs(x.t - x.g) <= 3 for x in got)
