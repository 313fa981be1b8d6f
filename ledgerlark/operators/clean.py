"""Cleaning of the four entities, step by step and composed."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark import schema as S
from ledgerlark.functions import cleaning as C

# --- steps -------------------------------------------------------------------


def add_ingest_ts(df: DataFrame, at: datetime | Column | None = None) -> DataFrame:
    """Add ``ingest_date``: the time of the query, or ``at`` for repeatable runs."""
    when = F.current_timestamp() if at is None else (at if isinstance(at, Column) else F.lit(at))
    return df.withColumn("ingest_date", when.cast("timestamp"))


def rename_customers(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(S.CUSTOMER_RENAMES)


def filter_not_null(df: DataFrame, column: str = "annual_income") -> DataFrame:
    return df.where(F.col(column).isNotNull())


def rows_null(df: DataFrame, column: str = "loan_amount") -> DataFrame:
    return df.where(F.col(column).isNull())


def drop_null_rows(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def clean_emp_length(customers: DataFrame) -> DataFrame:
    return customers.withColumn("emp_length", C.emp_length_years(F.col("emp_length")))


def avg_emp_length(customers: DataFrame) -> DataFrame:
    """One row: the mean employment length, rounded down."""
    return customers.agg(F.floor(F.avg("emp_length")).alias("avg_emp_length"))


def impute_emp_length(customers: DataFrame) -> DataFrame:
    """Fill a missing length with the rounded-down mean of the same frame.

    The mean is a scalar subquery of the plan, so nothing comes back to the driver program.
    """
    mean = avg_emp_length(customers).scalar().cast("int")
    return customers.withColumn("emp_length", F.coalesce(F.col("emp_length"), mean))


def clean_state(customers: DataFrame) -> DataFrame:
    return customers.withColumn("address_state", C.state_code(F.col("address_state")))


def filter_too_long(df: DataFrame, column: str = "address_state", longest: int = 2) -> DataFrame:
    return df.where(F.length(column) > longest)


def clean_term(loans: DataFrame) -> DataFrame:
    return loans.withColumn("loan_term_months", C.term_years(F.col("loan_term_months"))).withColumnRenamed(
        "loan_term_months", "loan_term_years"
    )


def clean_purpose(loans: DataFrame, known: Iterable[str] = S.LOAN_PURPOSES) -> DataFrame:
    return loans.withColumn("loan_purpose", C.known_purpose(F.col("loan_purpose"), known))


def filter_inconsistent_zero(repayments: DataFrame) -> DataFrame:
    return repayments.where(
        C.inconsistent_zero(F.col("total_payment_received"), F.col("total_principal_received"))
    )


def repair_total_payment(repayments: DataFrame) -> DataFrame:
    return repayments.withColumn(
        "total_payment_received",
        C.repaired_payment(
            F.col("total_payment_received"),
            F.col("total_principal_received"),
            F.col("total_interest_received"),
            F.col("total_late_fee_received"),
        ),
    )


def filter_paid(repayments: DataFrame) -> DataFrame:
    return repayments.where(F.col("total_payment_received") != F.lit(0.0))


def filter_zero_date(repayments: DataFrame, column: str = "last_payment_date") -> DataFrame:
    return repayments.where(C.is_zero_text(F.col(column)))


def null_zero_dates(
    repayments: DataFrame, columns: Iterable[str] = ("last_payment_date", "next_payment_date")
) -> DataFrame:
    return repayments.withColumns({c: C.null_if_zero_text(F.col(c)) for c in columns})


def clean_counts(defaulters: DataFrame, columns: Iterable[str]) -> DataFrame:
    return defaulters.withColumns({c: C.count_or_zero(F.col(c)) for c in columns})


def filter_delinquent(defaulters: DataFrame) -> DataFrame:
    return defaulters.where((F.col("delinq_2yrs") > 0) | (F.col("mths_since_last_delinq") > 0))


def delinquency_select(defaulters: DataFrame) -> DataFrame:
    return defaulters.select(
        "member_id",
        "delinq_2yrs",
        "delinq_amnt",
        F.col("mths_since_last_delinq").try_cast("int").alias("mths_since_last_delinq"),
    )


def filter_records_enq(defaulters: DataFrame) -> DataFrame:
    """Members with a record, bankruptcy or enquiry; a missing count is no hit."""
    records, bankruptcies, enquiries = (F.col(c) > 0.0 for c in S.RECORD_COUNTS)
    return defaulters.where(records | bankruptcies | enquiries).select("member_id")


def records_detail_select(defaulters: DataFrame) -> DataFrame:
    return defaulters.select("member_id", *S.RECORD_COUNTS)


# --- whole entities ----------------------------------------------------------


def distinct_customers(customers: DataFrame) -> DataFrame:
    """Renamed customers without repeated rows and without rows that have no income.

    The income filter is pushed below the shuffle of the distinct, and equal rows are merged before
    it, so neither a hot member without income nor a hot copy reaches one task.
    """
    return filter_not_null(rename_customers(customers).distinct())


def finish_customers(customers: DataFrame, ingest_at: datetime | Column | None = None) -> DataFrame:
    """What follows the distinct: employment length, its mean, state, ingest time.

    The ingest time is one constant per query, so adding it after the distinct gives the same rows
    and keeps it out of the shuffle.
    """
    return add_ingest_ts(clean_state(impute_emp_length(clean_emp_length(customers))), ingest_at)


def clean_customers(customers: DataFrame, ingest_at: datetime | Column | None = None) -> DataFrame:
    """Job order: rename, distinct, income filter, employment length, its mean, state."""
    return finish_customers(distinct_customers(customers), ingest_at)


def clean_loans(loans: DataFrame, ingest_at: datetime | Column | None = None) -> DataFrame:
    kept = drop_null_rows(loans, S.LOAN_REQUIRED)
    return add_ingest_ts(clean_purpose(clean_term(kept)), ingest_at)


def clean_repayments(repayments: DataFrame, ingest_at: datetime | Column | None = None) -> DataFrame:
    """The repair comes before the filter: a repaired total is no longer zero."""
    kept = drop_null_rows(repayments, S.REPAYMENT_REQUIRED)
    return add_ingest_ts(null_zero_dates(filter_paid(repair_total_payment(kept))), ingest_at)


def clean_delinquency(defaulters: DataFrame) -> DataFrame:
    return delinquency_select(filter_delinquent(clean_counts(defaulters, ["delinq_2yrs"])))


def records_enquiries(defaulters: DataFrame) -> DataFrame:
    return filter_records_enq(clean_counts(defaulters, ["delinq_2yrs"]))


def clean_records_detail(defaulters: DataFrame) -> DataFrame:
    return records_detail_select(clean_counts(defaulters, ["delinq_2yrs", *S.RECORD_COUNTS]))
