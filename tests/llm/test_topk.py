"""Wide vectors, large values and clashing columns in exact top-k search."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundlake.llm import topk

VECTORS = "vec_id long, embedding array<double>"
WIDE = (32 << 20) // 8 + 1


def expected(rows, k, every=20):
    floor = lambda x: int(x * 64 // 1)
    own = [(i, [floor(x) for x in v]) for i, v in rows]
    out = []
    for q, v in own:
        if q % every == 0:
            clip = lambda s: max(min(s, (1 << 63) - 1), -(1 << 63))
            best = sorted((-clip(sum(a * b for a, b in zip(v, w, strict=False))), i) for i, w in own if i != q)[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    return sorted(out)


def found(df, k, every=20):
    return sorted(tuple(r) for r in topk.top_k(df.where(f"vec_id % {every} = 0"), df, k).collect())


def test_one_wide_vector(spark):
    """A vector too wide for any seed changes nothing for the others."""
    r = random.Random(1)
    rows = [(i, [r.uniform(-2, 2), r.uniform(-2, 2)]) for i in range(25)]
    small = spark.createDataFrame(rows, VECTORS)
    wide = spark.range(1).select(F.lit(100).cast("long").alias("vec_id"), F.array_repeat(F.lit(0.5), WIDE).alias("embedding"))
    got = found(small.union(wide), 3)
    assert got == expected([*rows, (100, [0.5] * WIDE)], 3) and len(got) == 9


def test_only_wide_vectors(spark, monkeypatch):
    """Nothing can be a seed: there are no floors and one cell."""
    monkeypatch.setattr(topk, "SEED_BYTES", 64)
    monkeypatch.setattr(topk, "BLOCK_BYTES", 4096)
    r = random.Random(2)
    rows = [(i, [r.uniform(-2, 2) for _ in range(r.choice([30, 31, 40, 200]))]) for i in range(150)]
    assert found(spark.createDataFrame(rows, VECTORS), 7) == expected(rows, 7)


@pytest.mark.parametrize("size", [1e8, 1e18, 1e300])
def test_large_values(spark, size):
    r = random.Random(3)
    rows = [(i, [r.uniform(-1, 1) * (size if i % 3 == 0 else 1) for _ in range(r.choice([4, 9]))]) for i in range(60)]
    assert found(spark.createDataFrame(rows, VECTORS), 5) == expected(rows, 5)


def test_values_that_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.7e308, 0.0]), (2, [float("nan"), 0.0]), (3, [float("inf")]), (4, None), (5, []), (None, [1.0, 1.0]), (6, [3.0]), (20, [-1.0, 0.25, 9.0])]
    got = found(spark.createDataFrame(rows, VECTORS), 10)
    assert got == expected([(i, v) for i, v in rows if i in (0, 5, 6, 20)], 10)


def test_clashing_columns(spark):
    r = random.Random(4)
    rows = [(i, [r.uniform(-1, 1) for _ in range(6)]) for i in range(50)]
    df = spark.createDataFrame([(i, v, "x", i, [1.0]) for i, v in rows], "vec_id long, embedding array<double>, id string, cell long, v array<double>")
    assert found(df, 4) == expected(rows, 4)


def test_unlike_lengths_are_filled_up_to_a_power_of_two():
    r = np.random.default_rng(5)
    import pyarrow as pa

    values = [r.normal(size=n) for n in (0, 1, 2, 3, 17, 18, 64)]
    x = topk.Vectors(pa.array([v.tolist() for v in values]))
    full = np.array([np.pad(v, (0, 64 - len(v))) for v in values])
    assert np.allclose(x.stats(64, 5), topk.summary(full, 5))
    assert sorted(sum((rows.tolist() for rows, _ in x.classes()), [])) == list(range(7))
    for rows, width in x.classes():
        assert (x.dense(rows, width) == full[rows, :width]).all() and (x.dense(rows, 2) == full[rows, :2]).all()
