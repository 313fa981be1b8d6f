"""Profiles, repeated keys and removal of members with repeated rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions import cleaning as C
from ledgerlark.functions.keys import packed, unpacked
from ledgerlark.operators.skew import DEFAULT_LIMITS, SkewLimits, anti_join, drop_heavy

MEMBER = "member_id"

# --- counts and profiles -----------------------------------------------------


def count_rows(df: DataFrame, alias: str = "total_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def count_distinct_members(df: DataFrame, key: str = MEMBER, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct(key) if approximate else F.countDistinct(key)
    return df.agg(count.alias("distinct_members"))


def profile_nulls(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """NULLs of every column in one pass: one row, one column per input column."""
    return df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns or df.columns))


def profile_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that meet each rule, all in one pass."""
    return df.agg(*(F.count_if(rule).alias(name) for name, rule in rules.items()))


def repayment_rules(columns: Mapping[str, Column] | None = None) -> dict[str, Column]:
    """Rules over repayments; ``columns`` gives the values where the frame has other names."""

    def col(name: str) -> Column:
        return F.col(name) if columns is None else columns[name]

    total, principal = col("total_payment_received"), col("total_principal_received")
    return {
        "zero_payment": total == 0.0,
        "inconsistent_zero_payment": C.inconsistent_zero(total, principal),
        "zero_last_payment_date": C.is_zero_text(col("last_payment_date")),
        "zero_next_payment_date": C.is_zero_text(col("next_payment_date")),
        "null_last_payment_date": col("last_payment_date").isNull(),
        "null_next_payment_date": col("next_payment_date").isNull(),
    }


def customer_rules() -> dict[str, Column]:
    return {
        "null_income": F.col("annual_income").isNull(),
        "null_emp_length": F.col("emp_length").isNull(),
        "long_state": F.length("address_state") > 2,
    }


# --- values and keys ---------------------------------------------------------


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def sort_counts(counts: DataFrame, total: str = "total") -> DataFrame:
    """Largest count first. The other columns break ties, which also spreads equal counts over tasks."""
    others = [F.col(c).asc_nulls_first() for c in counts.columns if c != total]
    return counts.orderBy(F.col(total).desc(), *others)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return sort_counts(df.groupBy(column).agg(F.count(F.lit(1)).alias("total")))


def key_multiplicity(df: DataFrame, key: str = MEMBER) -> DataFrame:
    return value_counts(df, key)


def top_k_members(df: DataFrame, k: int = 20, key: str = MEMBER) -> DataFrame:
    """The ``k`` keys with most rows. Each task keeps its own best ``k`` only."""
    return key_multiplicity(df, key).limit(k)


def members_repeated(df: DataFrame, key: str = MEMBER) -> DataFrame:
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("total_cnt"))
    return sort_counts(counts.where(F.col("total_cnt") > 1), "total_cnt")


def duplicate_keys(df: DataFrame, key: str = MEMBER) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select(key)


def filter_key_prefix(df: DataFrame, prefix: str, key: str = MEMBER) -> DataFrame:
    return df.where(F.col(key).startswith(prefix))


def filter_key_equals(df: DataFrame, value: str, key: str = "loan_id") -> DataFrame:
    return df.where(F.col(key) == value)


# --- members with repeated rows ----------------------------------------------


def member_row_counts(tables: Mapping[str, DataFrame], key: str = MEMBER) -> DataFrame:
    """Rows per member in each table: ``(key, <name>...)``, one shuffle for all tables.

    Keys of all tables go through one aggregation that counts before the shuffle; text keys are packed
    on their way.
    """
    text = all(dict(df.dtypes)[key] == "string" for df in tables.values())
    tagged = None
    for name, df in tables.items():
        one = df.select((packed(F.col(key)) if text else F.col(key)).alias(key), F.lit(name).alias("_table"))
        tagged = one if tagged is None else tagged.union(one)
    counts = tagged.groupBy(key).agg(*(F.count_if(F.col("_table") == n).alias(n) for n in tables))
    return counts.withColumn(key, unpacked(F.col(key))) if text else counts


def union_bad(tables: Mapping[str, DataFrame], key: str = MEMBER) -> DataFrame:
    """Key once for every table in which it has more than one row (UNION ALL of the lists)."""
    counts = member_row_counts(tables, key)
    hits = F.array(*(F.when(F.col(n) > 1, F.lit(n)) for n in tables))
    return counts.select(key, F.explode(F.array_compact(hits)).alias("_table")).select(key)


def repeated_members(tables: Mapping[str, DataFrame], key: str = MEMBER) -> DataFrame:
    """Members with more than one row in any of the tables, with their rows in each: ``(key, <name>...)``."""
    counts = member_row_counts(tables, key)
    return counts.where(F.greatest(*(F.col(n) for n in tables), F.lit(0)) > 1)


def bad_members(tables: Mapping[str, DataFrame], key: str = MEMBER) -> DataFrame:
    """Distinct members with more than one row in any of the tables."""
    return repeated_members(tables, key).select(key)


def anti_join_bad(
    df: DataFrame,
    bad: DataFrame,
    key: str = MEMBER,
    limits: SkewLimits = DEFAULT_LIMITS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Remove the members of a bad list, of any size, from any table; see :func:`skew.anti_join`."""
    return anti_join(df, bad, key, limits, counts)


def unique_rows(df: DataFrame, key: str = MEMBER) -> DataFrame:
    """The rows whose key occurs once.

    One aggregation: a repeated key is merged before the shuffle, so a hot key costs one row per
    task, and the result is already partitioned by the key for the joins that follow. The maximum of
    a column over a single row is that row's value.
    """
    others = [c for c in df.columns if c != key]
    once = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), *(F.max(c).alias(c) for c in others)
    )
    return once.where(F.col("_n") == 1).select(*df.columns)


def without_repeated(
    name: str,
    tables: Mapping[str, DataFrame],
    key: str = MEMBER,
    repeated: DataFrame | None = None,
    limits: SkewLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """``tables[name]`` less the members that are repeated in any of ``tables``.

    Equal to removing :func:`bad_members` from it by ``NOT IN``. ``repeated`` is the stored outcome of
    :func:`repeated_members` over the same tables, for callers that need several of them: the members are
    counted once then. The heaviest members leave by a broadcast, and they are among the repeated ones,
    so the anti join that follows has no hot key. Without it, members repeated in the table itself go in
    :func:`unique_rows`, which leaves one row per member to the anti join. A row without a member goes unless
    no member is repeated, and a repeated NULL leaves no row.
    """
    bad = bad_members(tables, key) if repeated is None else repeated.select(key)
    listed = bad.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(key).isNull()).alias("nulls"))
    state = listed.select(F.struct("n", "nulls")).scalar()
    none_bad, null_bad = state["n"] == 0, state["nulls"] > 0
    if repeated is None:
        rows = unique_rows(tables[name], key)
    else:
        own = repeated.where(F.col(key).isNotNull()).select(key, F.col(name).alias("n"))
        rows = drop_heavy(tables[name], own, key, limits, counts=own)
    kept = rows.where(none_bad | (F.col(key).isNotNull() & ~null_bad))
    return kept.join(bad, key, "left_anti")


def verify_dedup(df: DataFrame, key: str = MEMBER) -> DataFrame:
    """One row: the largest number of rows of a member, and whether it is at most one."""
    most = F.coalesce(F.max("n"), F.lit(0))
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(most.alias("most_rows"), (most <= 1).alias("passed"))


def check_unique(df: DataFrame, key: str) -> DataFrame:
    """``df`` unchanged, but its query fails when a non-NULL ``key`` occurs more than once."""
    repeated = (
        df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1).agg(F.count(F.lit(1))).scalar()
    )
    fail = F.raise_error(F.lit(f"column {key} is not unique"))
    return df.where(F.when(repeated > 0, fail.cast("boolean")).otherwise(F.lit(True)))
