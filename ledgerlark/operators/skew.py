"""Joins on a key of which one value may hold a large share of all rows.

The building block is :func:`heavy_keys`: fewer than ``max_keys`` keys can each own more than
``1 / max_keys`` of a table's rows, whatever its size, so that list may be broadcast. Counts are
exact, which makes the list the same each time a lost task computes it again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SkewLimits:
    """A key is heavy above ``1 / max_keys`` of the rows, but never below ``min_rows`` rows.

    ``max_keys`` is about the number of shuffle partitions of a large job: a key below its share is
    no larger than an average partition. At 64 bytes a key, the broadcast list stays below 1 MB.
    """

    max_keys: int = 10_000
    min_rows: int = 1_000_000

    def __post_init__(self):
        if self.max_keys < 1 or self.min_rows < 1:
            raise ValueError("max_keys and min_rows are at least 1")


DEFAULT_LIMITS = SkewLimits()


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per key. Counted before the shuffle, so a hot key sends one row per task."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def heavy_of(counts: DataFrame, key: str, limits: SkewLimits = DEFAULT_LIMITS) -> DataFrame:
    """Fewer than ``max_keys`` rows ``(key, n, slices)`` of counts ``(key, n)``.

    A slice is at most one threshold of rows.
    """
    total = counts.agg(F.sum("n")).scalar()
    threshold = F.greatest(total / F.lit(limits.max_keys), F.lit(float(limits.min_rows)))
    return _above(counts, key, threshold)


def _above(counts: DataFrame, key: str, threshold: Column) -> DataFrame:
    return counts.where(F.col("n") > threshold).select(
        key, "n", F.ceil(F.col("n") / threshold).cast("int").alias("slices")
    )


def heavy_keys(df: DataFrame, key: str, limits: SkewLimits = DEFAULT_LIMITS) -> DataFrame:
    """The keys with a large share of the rows of ``df``, see :func:`heavy_of`.

    Hashes are counted first, which shuffles 16 bytes a key, whatever its width. A hash counts at least
    what each of its keys does, so only rows of the few heavy hashes are counted by key. ``df`` is read
    twice: give a stored table.
    """
    rows = df.where(F.col(key).isNotNull()).select(key, F.xxhash64(key).alias("_hash"))
    hashes = rows.groupBy("_hash").agg(F.count(F.lit(1)).alias("n"))
    total = hashes.agg(F.sum("n")).scalar()
    threshold = F.greatest(total / F.lit(limits.max_keys), F.lit(float(limits.min_rows)))
    suspects = hashes.where(F.col("n") > threshold).select("_hash")
    counts = rows.join(F.broadcast(suspects), "_hash", "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return _above(counts, key, threshold)


def _heavy(df: DataFrame, key: str, limits: SkewLimits, counts: DataFrame | None) -> DataFrame:
    """Heavy keys of ``df`` by its known ``counts``, or counted."""
    return heavy_keys(df, key, limits) if counts is None else heavy_of(counts, key, limits)


def _row_slice(df: DataFrame, slices: Column) -> Column:
    """A slice number for each row that a repeated task gives again.

    The partition number spreads full copies of a row over slices.
    """
    return F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), slices).cast("int")


def anti_join(
    df: DataFrame,
    listed: DataFrame,
    key: str,
    limits: SkewLimits = DEFAULT_LIMITS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Rows of ``df`` whose key is not in ``listed``, where a NULL fails the query.

    As with ``NOT IN``, rows with a NULL key go unless the list is empty. ``listed`` is read up to three
    times: give a stored list. ``counts`` are known ``(key, n)`` of ``df``; without them keys are counted.

    Whether a heavy key is listed is answered by a broadcast of the heavy keys. Rows of listed heavy
    keys leave before the shuffle; rows of the other heavy keys cannot match any more and are spread
    evenly over it.
    """
    keys = not_null_key(listed.select(key), key)
    none_listed = keys.limit(1).agg(F.count(F.lit(1)) == 0).scalar()
    heavy = _heavy(df, key, limits, counts).select(key)
    listed_heavy = keys.join(F.broadcast(heavy), key, "left_semi").distinct()
    verdict = heavy.join(F.broadcast(listed_heavy.withColumn("_listed", F.lit(True))), key, "left")
    verdict = verdict.select(key, F.coalesce("_listed", F.lit(False)).alias("_listed"))

    spread = F.concat(F.lit("\u0000"), F.xxhash64(*df.columns, F.spark_partition_id()).cast("string"))
    tagged = (
        df.where(F.col(key).isNotNull() | none_listed)
        .join(F.broadcast(verdict), key, "left")
        .where(F.col("_listed").isNull() | ~F.col("_listed"))
        .withColumn("_probe", F.when(F.col("_listed").isNull(), F.col(key)).otherwise(spread))
    )
    probes = keys.withColumnRenamed(key, "_probe")
    return tagged.join(probes, "_probe", "left_anti").select(*df.columns)


def drop_heavy(
    df: DataFrame,
    counted: DataFrame,
    key: str,
    limits: SkewLimits = DEFAULT_LIMITS,
    listed: DataFrame | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Leave out the rows whose key is heavy in ``counted``, by a broadcast of those few keys.

    For keys that cannot reach the result, because they are repeated in ``counted`` or are in
    ``listed``, the only ones looked at when it is given. The light ones among them are left for the
    join that drops them. ``counts`` are known ``(key, n)`` of ``counted``.
    """
    heavy = _heavy(counted, key, limits, counts)
    if listed is None:
        heavy = heavy.where("n > 1").select(key)
    else:
        heavy = listed.select(key).join(F.broadcast(heavy.select(key)), key, "left_semi").distinct()
    return df.join(F.broadcast(heavy), key, "left_anti")


def sliced_star_join(
    base: DataFrame,
    sides: Sequence[DataFrame],
    key: str,
    how: str = "left",
    limits: SkewLimits = DEFAULT_LIMITS,
    counted: Sequence[DataFrame | None] | None = None,
    base_keys: DataFrame | None = None,
    counts: Sequence[DataFrame | None] | None = None,
) -> DataFrame:
    """``base`` joined with each of ``sides`` on ``key`` (``left`` or ``inner``), without a hot task.

    ``counted`` may name, for ``base`` and each side, a cheaper frame that has the same keys in about
    the same numbers, or None for a table with one row per key; ``base_keys`` one with the base's
    keys. Heavy keys are searched there, so that a join in ``base`` is not worked out twice. ``counts`` gives
    known ``(key, n)`` of these frames instead.

    Sides hold distinct column names besides the key. Every table that has a heavy key deals that
    key's rows out over slices of its own dimension and repeats them over the slices of the other
    tables' dimensions, so each combination of rows meets exactly once. The place in this grid is
    one number, so all joins use the same two columns and each table is shuffled once. Keys that
    are not heavy have a grid of one place.

    In a left join, a base row repeated over slices where the side has no row would show up as
    unmatched although it matches elsewhere. A heavy key of a side does have rows there, so for
    sliced sides unmatched rows are left out again.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type {how}")
    tables = [base, *sides]
    dims = range(len(tables))

    found = None
    frames = tables if counted is None else counted
    for i, frame in enumerate(frames):
        known = None if counts is None else counts[i]
        if known is None and (counts is not None or frame is None):
            continue
        one = _heavy(frame, key, limits, known).select(key, F.lit(i).alias("_dim"), "slices")
        found = one if found is None else found.unionByName(one)
    # Both lists have at most len(tables) * max_keys rows.
    in_base = (base if base_keys is None else base_keys).select(key)
    in_base = in_base.join(F.broadcast(found.select(key).distinct()), key, "left_semi").distinct()
    plan = (
        found.groupBy(key)
        .agg(*(F.max(F.when(F.col("_dim") == i, F.col("slices"))).alias(f"_s{i}") for i in dims))
        .join(F.broadcast(in_base.withColumn("_in_base", F.lit(True))), key, "left")
        .select(key, F.coalesce("_in_base", F.lit(False)).alias("_in_base"), *(f"_s{i}" for i in dims))
    )

    def slices(i: int) -> Column:
        return F.coalesce(F.col(f"_s{i}"), F.lit(1))

    def grid(some) -> Column:
        places = F.lit(1).cast("long")
        for j in some:
            places = places * slices(j)
        return places

    def deal(i: int, table: DataFrame) -> DataFrame:
        tagged = table.join(F.broadcast(plan), key, "left")
        # Heavy keys of a side that the base lacks cannot reach the result: they go before the shuffle.
        tagged = tagged.where(F.col("_in_base").isNull() | F.col("_in_base"))
        below, above = grid(range(i)), grid(range(i + 1, len(tables)))
        own = _row_slice(table, slices(i))
        repeats = F.explode(F.sequence(F.lit(0).cast("long"), below * above - 1))
        placed = tagged.withColumn("_own", own).withColumn("_other", repeats)
        rest = F.floor(F.col("_other") / below).cast("long")
        place = F.pmod(F.col("_other"), below) + F.col("_own") * below + rest * below * slices(i)
        unused = ["_own", "_other", "_in_base", *(f"_s{j}" for j in dims if i != 0 or j == 0)]
        return placed.withColumn("_place", place).drop(*unused)

    joined = deal(0, base)
    for i, side in enumerate(sides, start=1):
        joined = joined.join(deal(i, side.withColumn(f"_m{i}", F.lit(True))), [key, "_place"], how)
        if how == "left":
            joined = joined.where((slices(i) == 1) | F.col(f"_m{i}").isNotNull())
    kept = [*base.columns, *(c for side in sides for c in side.columns if c != key)]
    return joined.select(*kept)


def not_null_key(df: DataFrame, key: str) -> DataFrame:
    """Fail the query on a NULL key: a NULL in a NOT IN list would empty the result."""
    return df.withColumn(
        key, F.coalesce(F.col(key), F.raise_error(F.lit(f"NULL in key column {key}")))
    )
