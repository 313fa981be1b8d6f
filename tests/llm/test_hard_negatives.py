"""Hard negatives against all scores, and Strassen products against plain ones."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm.hard_negatives import hard_negatives, strassen

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("shape", [(1, 1, 1), (33, 65, 67), (9, 64, 130), (0, 5, 3), (5, 0, 3), (100, 7, 0)])
def test_products_of_any_shape(shape):
    rng = np.random.default_rng(3)
    rows, inner, columns = shape
    a, b = rng.integers(-(2**20), 2**20, (rows, inner)), rng.integers(-(2**20), 2**20, (inner, columns))
    assert (strassen(a, b, leaf=4) == a @ b).all()


def test_intermediate_sums_may_wrap():
    a = np.full((8, 8), 2**59, dtype=np.int64)
    b = np.eye(8, dtype=np.int64) * 15
    assert (strassen(a, b, leaf=2) == a * 15).all()


def brute(rows, positives=5, negatives=10):
    kept = []
    for nth, (i, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        kept.append((i, nth, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    for i, nth, label, q in kept:
        if i is None or i % 100:
            continue
        scored = [
            (-sum(x * y for x, y in zip(q, other, strict=False)), j is None, j or 0, m, its)
            for j, m, its, other in kept if m != nth
        ]
        scored.sort(key=lambda r: r[:4])
        for p in [r for r in scored if r[4] == label][:positives]:
            inside = [r for r in scored if r[4] != label and -30 * p[0] <= -100 * r[0] <= -90 * p[0]]
            for rank, r in enumerate(inside[:negatives], 1):
                out.append((i, None if p[1] else p[2], rank, None if r[1] else r[2], -p[0], -r[0]))
    return sorted(out, key=repr)


def found(df, **sizes):
    given = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (given + 1) % 10).otherwise(given)
    out = hard_negatives(df, anchor=F.col("vec_id") % 100 == 0, label=label, **sizes)
    return sorted((tuple(r) for r in out.collect()), key=repr)


def case(seed, n, values):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        vector = [rng.choice(values) for _ in range(6)]
        rows.append((i * 20 if rng.random() < 0.9 else None, vector, rng.choice([0, 1, 2, None])))
    odd = [(100, None, 1), (200, [1.0, None], 1), (300, [math.nan], 1), (400, [math.inf, 1.0], 1),
           (500, [], 1), (600, [1.0], 0), (3, [1.0, 1.0, 0.5, 0.5, 1.0, 0.25, 9.0], 1)]
    return rows + odd + rows[:15]


@pytest.mark.parametrize(
    ("n", "values", "tiles"),
    [(120, [0.0, 0.5, 1.0], (3, 7)), (80, [-1.0, -0.3, 0.7, 1.3], (2, 50)), (80, [0.25, 0.3], (2048, 4096))],
)
def test_equals_all_scores(spark, n, values, tiles):
    rows = case(n, n, values)
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    assert found(df, anchors_a_tile=tiles[0], rows_a_tile=tiles[1]) == brute(rows)


def test_no_rows_no_anchors_no_usable_rows(spark):
    for rows in ([], [(1, [1.0], 1), (2, [1.0], 2)], [(100, None, 1), (200, [1.0], None)]):
        assert found(spark.createDataFrame(rows, SCHEMA)) == []


def test_large_components_stay_exact(spark):
    rows = [(100, [2.0**21, 1.0], 1), (1, [2.0**21, 0.5], 1), (2, [2.0**20, 0.25], 2), (3, [2.0**56, 0.0], 2)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows[:3])


def test_extra_columns_of_any_name(spark):
    rows = case(5, 60, [0.0, 0.5, 1.0])
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    wide = df
    for name in ("nth", "id", "a", "c", "n", "vector", "is_anchor", "score", "place", "windows", "anchor_id"):
        wide = wide.withColumn(name, F.lit("x"))
    assert found(wide) == brute(rows)
