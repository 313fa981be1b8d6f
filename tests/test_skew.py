import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from small_tables import rows
from ledgerlark.operators import skew as W
from ledgerlark.operators.skew import SkewLimits

# Low limits, so that the small frames below have heavy keys.
LIMITS = SkewLimits(max_keys=20, min_rows=5)


def frame(spark, name, counts, seed=0, copies=False):
    """``counts`` rows per key with a column ``name``; ``copies`` makes the rows of a key equal."""
    data = [(k, 0 if copies else i) for k, n in counts.items() for i in range(n)]
    random.Random(seed).shuffle(data)
    return spark.createDataFrame(data, f"k string, {name} int").repartition(3)


def plain_star(base, sides, how):
    for side in sides:
        base = base.join(side, "k", how)
    return base


CASES = {
    "hot side, known to base": ({"h": 2, "a": 1, "b": 1}, {"h": 90, "a": 2}, {"h": 3, "b": 1}),
    "hot side, unknown to base": ({"a": 2, "b": 1}, {"h": 200, "a": 1}, {"h": 100, "b": 2}),
    "hot base": ({"h": 90, "a": 1}, {"h": 2, "c": 1}, {"a": 2}),
    "hot base without match": ({"h": 90, "a": 1}, {"a": 2}, {"a": 1}),
    "all hot": ({"h": 12, "a": 1}, {"h": 15, "a": 2}, {"h": 9, "g": 30}),
    "two hot keys": ({"h": 10, "g": 20, "a": 3}, {"h": 40, "g": 1, "a": 1}, {"g": 25}),
    "nothing hot": ({"a": 1, "b": 2}, {"a": 2}, {"c": 1}),
    "empty side": ({"h": 30, "b": 2}, {}, {"h": 1}),
}


# With ``copies`` the rows of a key are all alike.
@pytest.mark.parametrize(
    ("case", "how", "copies"),
    [(c, "left", False) for c in CASES]
    + [(c, "inner", False) for c in ("hot base", "all hot", "hot side, unknown to base")]
    + [(c, "left", True) for c in ("hot base without match", "all hot")],
)
def test_star_join_equals_plain_joins(spark, case, how, copies):
    base, one, two = CASES[case]
    b = frame(spark, "x", base, copies=copies)
    sides = [frame(spark, "y", one, 1, copies), frame(spark, "z", two, 2, copies)]
    assert rows(W.sliced_star_join(b, sides, "k", how, LIMITS)) == rows(plain_star(b, sides, how))


def test_star_join_spreads_a_hot_key(spark):
    base = frame(spark, "x", {"h": 1, "a": 1})
    side = frame(spark, "y", {"h": 1000, "a": 1})
    joined = W.sliced_star_join(base, [side], "k", "left", LIMITS)
    text = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_place" in text
    # The heavy list cuts the hot key into as many slices as it has thresholds of rows.
    heavy = W.heavy_keys(side, "k", LIMITS).collect()
    assert [(r.k, r.n) for r in heavy] == [("h", 1000)]
    assert heavy[0].slices == 20


def test_heavy_list_is_bounded(spark):
    counts = {f"k{i}": 10 for i in range(50)}
    assert W.heavy_keys(frame(spark, "x", counts), "k", SkewLimits(max_keys=49, min_rows=1)).count() == 0
    assert W.heavy_keys(frame(spark, "x", counts), "k", SkewLimits(max_keys=51, min_rows=1)).count() == 50
    assert W.heavy_keys(frame(spark, "x", counts), "k").count() == 0


@pytest.mark.parametrize("listed", [["h"], ["h", "g", "a"], ["a", "z"], []])
def test_anti_join_equals_not_in(spark, listed):
    df = frame(spark, "x", {"h": 60, "g": 40, "a": 2, "b": 1})
    bad = spark.createDataFrame([(k,) for k in listed], "k string")
    got = W.anti_join(df, bad, "k", LIMITS)
    assert rows(got) == [r for r in rows(df) if r[0] not in listed]
    assert got.columns == df.columns


def test_anti_join_repeated_list(spark):
    df = frame(spark, "x", {"h": 60, "a": 2, "b": 1})
    bad = spark.createDataFrame([("h",), ("h",), ("a",), ("a",)], "k string")
    assert [r[0] for r in rows(W.anti_join(df, bad, "k", LIMITS))] == ["b"]


def test_null_in_list_is_an_error(spark):
    df = frame(spark, "x", {"a": 2})
    bad = spark.createDataFrame([("a",), (None,)], "k string")
    with pytest.raises(PySparkException):
        W.anti_join(df, bad, "k").collect()


def test_drop_heavy(spark):
    df = frame(spark, "x", {"h": 60, "g": 50, "a": 2, "light": 1})
    counted = frame(spark, "y", {"g": 40, "a": 1, "light": 2})
    kept = W.drop_heavy(df, counted, "k", LIMITS)
    assert rows(kept.groupBy("k").agg(F.count(F.lit(1)))) == [("a", 2), ("h", 60), ("light", 1)]


def test_drop_heavy_of_a_list(spark):
    df = frame(spark, "x", {"h": 60, "g": 50, "a": 2})
    listed = spark.createDataFrame([("h",), ("a",), ("z",)], "k string")
    kept = W.drop_heavy(df, df, "k", LIMITS, listed)
    assert rows(kept.groupBy("k").agg(F.count(F.lit(1)))) == [("a", 2), ("g", 50)]


def test_star_join_counts_on_given_frames(spark):
    base = frame(spark, "x", {"h": 1, "a": 1, "b": 1})
    loans = frame(spark, "y", {"h": 200, "g": 300, "a": 2})
    extra = loans.withColumn("z", F.col("y") * 2)
    got = W.sliced_star_join(base, [extra], "k", "left", LIMITS, [None, loans.select("k")], base.select("k"))
    assert rows(got) == rows(base.join(extra, "k", "left"))


def test_unknown_join_type(spark):
    df = frame(spark, "x", {"a": 1})
    with pytest.raises(ValueError):
        W.sliced_star_join(df, [df], "k", "full")


def test_limits_below_one_are_refused():
    for limits in ((0, 1), (1, 0)):
        with pytest.raises(ValueError):
            W.SkewLimits(*limits)


def test_single_rows_are_never_heavy(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    assert rows(W.drop_heavy(df, df, "k", W.SkewLimits(10**9, 1))) == [("a",)]


def test_null_keys_as_in_not_in(spark):
    df = spark.createDataFrame([("a",), (None,)], "k string")
    listed = spark.createDataFrame([("b",)], "k string")
    assert rows(W.anti_join(df, listed, "k")) == [("a",)]
    assert rows(W.anti_join(df, listed.limit(0), "k")) == [(None,), ("a",)]


def test_heavy_keys_shuffle_hashes(spark):
    df = spark.range(1000).selectExpr("IF(id < 500, 'hot', concat('k', id)) AS k", "id AS v")
    limits = SkewLimits(max_keys=10, min_rows=100)
    assert [tuple(r) for r in W.heavy_keys(df, "k", limits).collect()] == [("hot", 500, 5)]
    text = W.heavy_keys(df, "k", limits)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_hash" in text
