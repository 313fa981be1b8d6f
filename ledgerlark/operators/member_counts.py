"""Rows per member and table, as a state that further raw files are added to.

The state has one row per (member, table) with the number of rows, but for customers one per distinct
row: a customer row that stands in two files counts once, so the state keeps a digest of each. States of
files merge in any order, and the state of two files together is the merge of their states. Bad lists,
repeated keys, multiplicities and heavy keys all follow from it, so nothing counts members again.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions.keys import packed, unpacked
from ledgerlark.operators import clean as K
from ledgerlark.operators import identity as I
from ledgerlark.operators.quality import MEMBER, sort_counts
from ledgerlark.operators.skew import DEFAULT_LIMITS, SkewLimits, heavy_of
from ledgerlark.sources.releases import Release, current_release

KINDS = ("customers", "loans", "delinq", "detail")
SEARCHED = ("customers", "delinq", "detail")
STATE, COUNTS, FILES = "member_state", "member_counts", "counted_files"


def _row_digest(df: DataFrame):
    """128 bits of a whole row; NULL and empty text differ."""
    values = (F.col(c).cast("string") for c in df.columns)
    parts = [F.coalesce(F.concat(F.octet_length(v), F.lit(":"), v), F.lit("-")) for v in values]
    return F.unhex(F.md5(F.concat(*parts).cast("binary")))


def _finished(rows: DataFrame) -> DataFrame:
    """One row per (member, kind, digest). Counted before the shuffle, so a hot member sends little.

    Members are packed and kinds are numbers on their way through the shuffle.
    """
    n = F.sum("n")
    number = F.element_at(F.create_map(*(F.lit(v) for i, k in enumerate(KINDS) for v in (k, i))), F.col("kind"))
    short = rows.select(packed(F.col(MEMBER)).alias(MEMBER), number.cast("byte").alias("kind"), "digest", "n")
    found = short.groupBy(MEMBER, "kind", "digest").agg(
        F.when(F.col("digest").isNull(), n).otherwise(F.least(n, F.lit(1))).alias("n")
    )
    name = F.element_at(F.array(*(F.lit(k) for k in KINDS)), F.col("kind") + 1)
    return found.select(unpacked(F.col(MEMBER)).alias(MEMBER), name.alias("kind"), "digest", "n")


def file_state(keyed: DataFrame) -> DataFrame:
    """The state of one raw file with its member key: ``member_id, kind, digest, n``.

    What cleaning leaves out is not counted. Of the customers only the digest is shuffled.
    """
    customers = K.filter_not_null(K.rename_customers(I.customers_entity(keyed)))
    defaulters = I.defaulters_entity(keyed)
    none = F.lit(None).cast("binary")
    counted = {
        "customers": customers.select(MEMBER, _row_digest(customers).alias("digest")),
        "loans": K.clean_loans(I.loans_entity(keyed)).select(MEMBER, none.alias("digest")),
        "delinq": K.clean_delinquency(defaulters).select(MEMBER, none.alias("digest")),
        "detail": K.clean_records_detail(defaulters).select(MEMBER, none.alias("digest")),
    }
    rows = None
    for kind, df in counted.items():
        one = df.withColumns({"kind": F.lit(kind), "n": F.lit(1).cast("long")})
        rows = one if rows is None else rows.unionByName(one)
    return _finished(rows)


def merge_states(first: DataFrame, *others: DataFrame) -> DataFrame:
    """The state of all files together."""
    for other in others:
        first = first.unionByName(other)
    return _finished(first)


def member_counts(state: DataFrame, kinds: Iterable[str] = KINDS) -> DataFrame:
    """One row per member: its rows in each table."""
    per_kind = (F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(k) for k in kinds)
    counts = state.withColumn(MEMBER, packed(F.col(MEMBER))).groupBy(MEMBER).agg(*per_kind)
    return counts.withColumn(MEMBER, unpacked(F.col(MEMBER)))


# --- what follows from the counts: no shuffle but for the order -------------------


def multiplicity_of(counts: DataFrame, kind: str) -> DataFrame:
    """Members of a table with their rows, most first."""
    found = counts.where(F.col(kind) > 0).select(MEMBER, F.col(kind).alias("total"))
    return sort_counts(found)


def repeated_in(counts: DataFrame, kind: str) -> DataFrame:
    """Members with more than one row in a table."""
    return counts.where(F.col(kind) > 1).select(MEMBER)


def bad_members_of(counts: DataFrame, kinds: Iterable[str] = SEARCHED) -> DataFrame:
    """Members with more than one row in any of the tables, each once."""
    return counts.where(F.greatest(*(F.col(k) for k in kinds), F.lit(0)) > 1).select(MEMBER)


def rows_per_member(counts: DataFrame, kind: str) -> DataFrame:
    """``(member_id, n)`` of one table, as the skew-safe joins take them."""
    return counts.where((F.col(kind) > 0) & F.col(MEMBER).isNotNull()).select(MEMBER, F.col(kind).alias("n"))


def heavy_members_of(counts: DataFrame, kind: str, limits: SkewLimits = DEFAULT_LIMITS) -> DataFrame:
    """The members that hold a large share of a table."""
    return heavy_of(rows_per_member(counts, kind), MEMBER, limits)


# --- the stored state -----------------------------------------------------------


def add_file(spark: SparkSession, keyed: DataFrame, file: str, prefix: str = "", path: str | None = None) -> Release:
    """Add a raw file, with its member key, to the state stored below ``prefix``, by one switch.

    A file that is in the state already is refused, so a repeated run counts nothing twice. Returns the
    release with the new state, counts and list of files.
    """
    shown = current_release(spark, prefix)
    added = spark.createDataFrame([(file,)], "file string")
    state = file_state(keyed)
    if shown is not None:
        files = spark.table(f"{prefix}{FILES}")
        if files.where(F.col("file") == file).limit(1).count():
            raise ValueError(f"{file} is counted already")
        added = files.unionByName(added)
        state = merge_states(spark.table(f"{prefix}{STATE}"), state)
    release = Release(spark, prefix, path)
    stored = release.write(STATE, state)
    release.write(COUNTS, member_counts(stored))
    release.write(FILES, added)
    release.switch()
    return release
