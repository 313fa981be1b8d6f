from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerlark.llm.membership import among, without
from ledgerlark.sources.scratch import BATCH_CONF, materialize


@pytest.mark.parametrize("most_bits", [64, 1 << 20])
@pytest.mark.parametrize("listed", ["id % 3 = 0", "id < 0", "true"])
def test_same_as_semi_and_anti_joins(spark, listed, most_bits):
    rows = spark.range(3000).select(F.col("id") % 1000, "id", F.lit("x").alias("_word")).toDF("k", "_bits", "_word")
    keys = materialize(spark.range(1000).where(listed).select(F.col("id").alias("k")), "keys")
    for made, kind in ((among, "left_semi"), (without, "left_anti")):
        got = made(rows, keys, "k", most_bits)
        assert got.columns == rows.columns
        assert sorted(got.collect()) == sorted(rows.join(keys, "k", kind).select(rows.columns).collect())


def test_rows_the_bitmap_decides_are_not_shuffled(spark):
    """At any size of the list only rows that it lets through are dealt out."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = materialize(spark.range(500).select(F.col("id").alias("k")), "keys")
        rows = materialize(spark.range(100_000).select(F.col("id").alias("k")), "rows")
        plan = among(rows, keys, "k")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and plan.index("BroadcastHashJoin") > plan.index("Exchange hashpartitioning")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_batch_rows_hold_for_one_write(spark):
    def sizes(batches):
        for batch in batches:
            yield batch.slice(0, 1)

    before = spark.conf.get(BATCH_CONF)
    assert materialize(spark.range(0, 50, 1, 1).mapInArrow(sizes, "id long"), "batches", 10).count() == 5
    assert spark.conf.get(BATCH_CONF) == before
