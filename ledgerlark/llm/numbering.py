"""Gapless numbers within groups of any size, without bringing a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

ROWS_PER_BUCKET = 20_000


def parts_for(rows: int, per_part: int = ROWS_PER_BUCKET) -> int:
    """How many parts ``rows`` rows are dealt over; grows with the rows, without a ceiling."""
    return max(1, -(-rows // per_part))


def number_within(
    df: DataFrame, group: Sequence[str], order: Sequence[str], name: str, parts: int
) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... within each ``group``, gapless, as a long.

    Rows are dealt into ``parts`` buckets by a hash of ``order``. A window numbers each (group, bucket);
    the counts of the buckets, one row each, give what stands before a bucket. Rows that are equal in
    all of ``order`` share a bucket and get their numbers in any order. Column names starting with
    ``_nb`` are used inside.
    """
    dealt = df.withColumn("_nb", F.pmod(F.xxhash64(*order), F.lit(parts)))
    cell = [*group, "_nb"]
    before = (
        dealt.groupBy(*cell)
        .agg(F.count(F.lit(1)).alias("_nb_n"))
        .withColumn(
            "_nb_before",
            F.coalesce(
                F.sum("_nb_n").over(
                    W.partitionBy(*group).orderBy("_nb").rowsBetween(W.unboundedPreceding, -1)
                ),
                F.lit(0).cast("long"),
            ),
        )
        .select(*cell, "_nb_before")
    )
    inner = W.partitionBy(*cell).orderBy(*order)
    numbered = dealt.withColumn("_nb_row", F.row_number().over(inner))
    return (
        numbered.join(before, cell)
        .withColumn(name, F.col("_nb_before") + F.col("_nb_row") - 1)
        .drop("_nb", "_nb_row", "_nb_before")
    )
