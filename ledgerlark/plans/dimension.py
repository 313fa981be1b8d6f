"""The customer dimension with history: stable surrogate keys and validity, merged load by load.

A version of a member is one set of attributes with the load it is valid from and the one it is valid to
(exclusive, NULL while it is current). A load closes the versions whose attributes changed and adds new
ones; members that a load does not mention stay as they are. A surrogate key is a function of the member and
the load its version starts with, so a repeated load gives the same keys, and facts keep theirs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators.quality import MEMBER
from ledgerlark.plans.unified import DIM_CUSTOMER, dim_customer

KEY, FROM, TO = "customer_key", "valid_from", "valid_to"


def _key(load: Column) -> Column:
    """128 bits as text."""
    member = F.coalesce(F.concat(F.lit("="), F.col(MEMBER)), F.lit(""))
    return F.md5(F.concat_ws("|", load.cast("string"), member).cast("binary"))


def _attributes(columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c != MEMBER]


def first_load(customers: DataFrame, load: int, columns: Sequence[str] = DIM_CUSTOMER) -> DataFrame:
    """The dimension of a first file of clean customers; loads are numbered upwards."""
    rows = dim_customer(customers).select(*columns)
    at = F.lit(load).cast("long")
    return rows.select(_key(at).alias(KEY), *columns, at.alias(FROM), F.lit(None).cast("long").alias(TO))


def merge_load(
    dimension: DataFrame, customers: DataFrame, load: int, columns: Sequence[str] = DIM_CUSTOMER
) -> DataFrame:
    """``dimension`` after one more file of clean customers.

    Closed versions pass through without a shuffle; current ones, one row per member, meet the file's one
    row per member in a full join. A load that was merged before changes nothing: its rows equal the
    current versions.
    """
    at = F.lit(load).cast("long")
    closed = dimension.where(F.col(TO).isNotNull())
    current = dimension.where(F.col(TO).isNull())
    names = _attributes(columns)
    new = dim_customer(customers).select(
        F.col(MEMBER).alias("_member"), F.struct(*names).alias("_new")
    ).withColumn("_seen", F.lit(True))
    old = current.withColumn("_old", F.struct(*names)).withColumn("_had", F.lit(True))
    joined = old.join(new, F.col(MEMBER).eqNullSafe(F.col("_member")), "full")
    had, seen = F.col("_had").isNotNull(), F.col("_seen").isNotNull()
    changed = seen & had & ~F.col("_old").eqNullSafe(F.col("_new"))
    kept = joined.where(had).withColumn(TO, F.when(changed, at))
    added = joined.where(seen & (changed | ~had)).select(
        F.col("_member").alias(MEMBER), "_new.*"
    )
    added = added.select(_key(at).alias(KEY), *columns, at.alias(FROM), F.lit(None).cast("long").alias(TO))
    shown = [KEY, *columns, FROM, TO]
    return closed.select(*shown).unionByName(kept.select(*shown)).unionByName(added)


def current_version(dimension: DataFrame) -> DataFrame:
    return dimension.where(F.col(TO).isNull())


def version_at(dimension: DataFrame, load: int) -> DataFrame:
    """The dimension as it was after a load."""
    return dimension.where((F.col(FROM) <= load) & (F.col(TO).isNull() | (F.col(TO) > load)))
