"""Summary tables behind the dashboard.

Definitions are this engine's own. Money is summed as decimal, so a result does not depend on the
order in which partial sums arrive. Every table is counted before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.cleaning import month_start
from ledgerlark.operators.quality import MEMBER

MONEY = "decimal(18,2)"


def _rows() -> Column:
    return F.count(F.lit(1))


def _money_sum(column: str) -> Column:
    return F.sum(F.col(column).cast(MONEY)).cast("double")


def share(df: DataFrame, column: str, name: str) -> DataFrame:
    """Rows and share of all rows per value. The total is a scalar subquery over the counts."""
    counts = df.groupBy(F.col(column).alias(name)).agg(_rows().alias("loans"))
    total = counts.agg(F.sum("loans")).scalar()
    return counts.select(name, "loans", F.round(F.col("loans") / total, 6).alias("share"))


def mart_status_share(loans: DataFrame) -> DataFrame:
    return share(loans, "loan_status", "loan_status")


def mart_purpose_share(loans: DataFrame) -> DataFrame:
    return share(loans, "loan_purpose", "loan_purpose")


def member_profile(customers: DataFrame) -> DataFrame:
    """One row per member of what the dashboard groups by.

    The values are part of the member key, so a member's rows agree; where NULL skipping made two
    people share a key, the smallest value is taken and each loan still counts once.
    """
    return customers.groupBy(MEMBER).agg(
        F.min("grade").alias("grade"),
        F.min("address_state").alias("address_state"),
        F.min("home_ownership").alias("home_ownership"),
        F.min("emp_length").alias("emp_length"),
        F.min("annual_income").alias("annual_income"),
    )


def is_default(status: Column) -> Column:
    text = F.lower(status)
    return text.contains("charged off") | text.contains("default")


def member_loans(loans: DataFrame) -> DataFrame:
    """Loans and defaulted loans per member."""
    return loans.groupBy(MEMBER).agg(
        _rows().alias("n"), F.count_if(is_default(F.col("loan_status"))).alias("bad")
    )


def _profiled_loans(loans: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per member on both sides, so the join has no hot key."""
    return member_loans(loans).join(member_profile(customers), MEMBER)


def mart_grade_share(loans: DataFrame, customers: DataFrame) -> DataFrame:
    counts = _profiled_loans(loans, customers).groupBy("grade").agg(F.sum("n").alias("loans"))
    total = counts.agg(F.sum("loans")).scalar()
    return counts.select("grade", "loans", F.round(F.col("loans") / total, 6).alias("share"))


def _month(column: str) -> Column:
    return F.date_format(month_start(F.col(column)), "yyyy-MM")


def mart_issue_trend(loans: DataFrame) -> DataFrame:
    return loans.groupBy(_month("issue_date").alias("issue_month")).agg(
        _rows().alias("loans"), _money_sum("funded_amount").alias("funded_amount")
    )


def mart_repayment_trend(repayments: DataFrame) -> DataFrame:
    """Payments per month of the last payment; loans without such a date are one NULL month."""
    return repayments.groupBy(_month("last_payment_date").alias("payment_month")).agg(
        _rows().alias("loans"),
        _money_sum("last_payment_amount").alias("last_payment_amount"),
        _money_sum("total_payment_received").alias("total_payment_received"),
    )


def income_band(income: Column, width: int = 25000) -> Column:
    """Lower edge of the income's band."""
    return (F.floor(income / F.lit(width)) * F.lit(width)).cast("long")


def _default_rate(loans: DataFrame, customers: DataFrame, segment: Column, name: str) -> DataFrame:
    per_segment = _profiled_loans(loans, customers).groupBy(segment.alias(name)).agg(
        F.sum("n").alias("loans"), F.sum("bad").alias("defaulted")
    )
    return per_segment.withColumn("default_rate", F.round(F.col("defaulted") / F.col("loans"), 6))


def mart_default_rate_state(loans: DataFrame, customers: DataFrame) -> DataFrame:
    return _default_rate(loans, customers, F.col("address_state"), "address_state")


def mart_default_rate_home(loans: DataFrame, customers: DataFrame) -> DataFrame:
    return _default_rate(loans, customers, F.col("home_ownership"), "home_ownership")


def mart_default_rate_emp(loans: DataFrame, customers: DataFrame) -> DataFrame:
    return _default_rate(loans, customers, F.col("emp_length"), "emp_length")


def mart_default_rate_income(loans: DataFrame, customers: DataFrame) -> DataFrame:
    return _default_rate(loans, customers, income_band(F.col("annual_income")), "income_band")


# --- all marts over loans in one pass ------------------------------------------

SHARES = {"mart_status_share": "loan_status", "mart_purpose_share": "loan_purpose", "mart_grade_share": "grade"}
RATES = {
    "mart_default_rate_state": "address_state", "mart_default_rate_home": "home_ownership",
    "mart_default_rate_emp": "emp_length", "mart_default_rate_income": "income_band",
}
DIMENSIONS = (*SHARES.values(), *RATES.values())


def mart_cube(loans: DataFrame, customers: DataFrame) -> DataFrame:
    """Loans and defaulted loans per value of every dimension: one scan and one join for all of them.

    Loans are summed per member, status and purpose, joined to one row per member, and summed again by
    grouping sets. ``dimension`` tells which column a row is about; the others are NULL. ``loans``
    counts all loans, ``known`` and ``defaulted`` those whose member has a customer row. Store the result:
    it has a row per value, and :func:`marts_of` reads it once per mart.
    """
    summed = loans.groupBy(MEMBER, "loan_status", "loan_purpose").agg(
        _rows().alias("n"), F.count_if(is_default(F.col("loan_status"))).alias("bad")
    )
    profile = member_profile(customers).withColumn("income_band", income_band(F.col("annual_income")))
    profile = profile.drop("annual_income").withColumn("_known", F.lit(True))
    joined = summed.join(profile, MEMBER, "left")
    known = F.col("_known").isNotNull()
    dimension = F.lit(None).cast("string")
    for name in DIMENSIONS:
        dimension = F.when(F.grouping(name) == 0, F.lit(name)).otherwise(dimension)
    return joined.groupingSets([[d] for d in DIMENSIONS], *DIMENSIONS).agg(
        dimension.alias("dimension"),
        F.sum("n").alias("loans"),
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("known"),
        F.coalesce(F.sum(F.when(known, F.col("bad"))), F.lit(0)).alias("defaulted"),
    )


def marts_of(cube: DataFrame) -> dict[str, DataFrame]:
    """The seven marts of a stored cube, with the columns of the functions of the same names."""
    out = {}
    for mart, column in SHARES.items():
        own = cube.where(F.col("dimension") == column)
        if column == "grade":
            # Of the customers; a value that only loans without a customer have is none.
            own = own.withColumn("loans", F.col("known")).where(F.col("known") > 0)
        total = own.agg(F.sum("loans")).scalar()
        out[mart] = own.select(column, "loans", F.round(F.col("loans") / total, 6).alias("share"))
    for mart, column in RATES.items():
        own = cube.where((F.col("dimension") == column) & (F.col("known") > 0))
        rate = F.round(F.col("defaulted") / F.col("known"), 6)
        out[mart] = own.select(column, F.col("known").alias("loans"), "defaulted", rate.alias("default_rate"))
    return out


def mart_score_histogram(scores: DataFrame, width: int = 250) -> DataFrame:
    """Loans per score bin, named by the bin's lower edge; loans without a score are the NULL bin."""
    edge = (F.floor(F.col("loan_score") / F.lit(width)) * F.lit(width)).cast("long")
    return scores.groupBy(edge.alias("score_bin")).agg(_rows().alias("loans"))


def mart_risk_category(scores: DataFrame) -> DataFrame:
    """Members and mean score per final grade."""
    mean = F.sum("loan_score").cast("double") / F.count("loan_score")
    return scores.groupBy("loan_final_grade").agg(
        F.countDistinct(MEMBER).alias("members"),
        F.round(F.when(F.count("loan_score") > 0, mean), 4).alias("mean_score"),
    )
