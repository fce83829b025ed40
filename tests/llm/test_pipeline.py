"""The pipeline's stages against the operators' reports, which are tested against brute force."""

import hashlib
import random

import pytest

import corpus_pipeline
from fundlake.llm import decontaminate, line_dedup, near_dedup, quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    where = f"file://{tmp_path_factory.mktemp('sf')}"
    r = random.Random(9)
    word = lambda: "".join(r.choice("etaoinshr") for _ in range(r.randint(2, 8)))
    line = " ".join(word() for _ in range(12))
    rows = []
    for i in range(240):
        body = " ".join(word() for _ in range(60))
        text = body.upper().replace(" ", "!! ") if i % 6 == 0 else f"{body}.\n{line}" if i % 5 == 0 else f"{body}."
        rows.append([i, text, "en", f"s{i % 3}" if i % 11 else None, len(text)])
    rows += [[300 + i, rows[i][1] + " x", "en", "s0", len(rows[i][1]) + 2] for i in range(1, 20)] + [[400, None, None, None, None], [401, "", "en", "s1", 0], [402, rows[1][1], "en", "s1", 1]]
    spark.createDataFrame([tuple(x) for x in rows], SCHEMA).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame([(i, int(i % 6 > 0), 0) for i in range(240)], "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame([(1, " ".join(rows[7][1].split()[5:25]))], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    return where


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages(spark, tables):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "near_dedup", "decontaminate", "mix"]
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    labels, bench = spark.read.parquet(f"{tables}/labels.parquet"), spark.read.parquet(f"{tables}/benchmark.parquet")
    expected = (
        lambda d: ids(quality.report(d, labels).where("predicted = 1")),
        ids,
        lambda d: ids(near_dedup.near_groups(d).where("kept")),
        lambda d: ids(decontaminate.contamination(d, bench).where("NOT contaminated")),
    )
    for (name, stage), wanted in zip(corpus_pipeline.STAGES, expected, strict=False):
        want = wanted(docs)
        digests = {r.doc_id: r.kept_sha256 for r in line_dedup.line_report(docs).collect()} if name == "line_dedup" else {}
        stage(spark, docs, tables).write.parquet(f"{tables}/{name}")
        docs = spark.read.parquet(f"{tables}/{name}")
        assert docs.columns == COLUMNS and ids(docs) == want, name
        for r in docs.collect() if digests else ():
            assert hashlib.sha256((r.text or "").encode()).hexdigest() == digests[r.doc_id]
            assert r.text is None or r.n_chars in (len(r.text), 1)
    assert 7 not in ids(docs)
    mix = corpus_pipeline.STAGES[4][1](spark, docs, tables)
    got = mix.collect()
    taken = sorted(r.doc_id for r in got)  # the next run removes what the stage's plan reads
    assert set(taken) <= set(ids(docs)) and all(1 <= r.copies <= 3 and r.taken == r.copies * r.size for r in got)
    assert ids(corpus_pipeline.run(spark, tables)) == taken
