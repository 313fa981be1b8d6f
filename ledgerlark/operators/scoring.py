"""The loan score: three groups of points, their weighted sum and a final grade."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark import schema as S
from ledgerlark.functions import points as P
from ledgerlark.functions.points import DEFAULT_PARAMS, ScoreParams
from ledgerlark.operators import clean as K
from ledgerlark.operators.identity import all_entities
from ledgerlark.operators.quality import anti_join_bad, unique_rows
from ledgerlark.operators.skew import DEFAULT_LIMITS, SkewLimits, drop_heavy, key_counts, sliced_star_join
from ledgerlark.sources.readers import widen

PAYMENT_PTS = ("last_payment_pts", "total_payment_pts")
DEFAULTER_PTS = ("delinq_pts", "public_records_pts", "public_bankruptcies_pts", "enq_pts")
HEALTH_PTS = ("loan_status_pts", "home_pts", "credit_limit_pts", "grade_pts")
SCORE_COLUMNS = (
    "member_id", "payment_history_pts", "defaulters_history_pts", "financial_health_pts",
    "loan_score", "loan_final_grade",
)


def _less_bad(df: DataFrame, bad: DataFrame | None, limits: SkewLimits) -> DataFrame:
    return df if bad is None else anti_join_bad(df, bad, limits=limits)


def _less_heavy_bad(df: DataFrame, bad: DataFrame | None, limits: SkewLimits) -> DataFrame:
    """For a side that an inner join with a side without bad members rids of the light ones."""
    return df if bad is None else drop_heavy(df, df, "member_id", limits, bad)


def join_loan_repayment(loans: DataFrame, repayments: DataFrame) -> DataFrame:
    return loans.join(repayments.drop("member_id", "ingest_date"), "loan_id")


def score_payment_history(
    loans: DataFrame,
    repayments: DataFrame,
    bad: DataFrame | None = None,
    params: ScoreParams = DEFAULT_PARAMS,
    limits: SkewLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Per loan with a repayment: ``member_id, last_payment_pts, total_payment_pts``.

    Members of ``bad`` leave before the join, so their rows are not shuffled by loan.
    """
    c = _less_bad(
        loans.select("loan_id", "member_id", "monthly_installment", "funded_amount"), bad, limits
    )
    p = repayments.select("loan_id", "last_payment_amount", "total_payment_received")
    return c.join(p, "loan_id").select(
        "member_id",
        P.last_payment_pts(F.col("last_payment_amount"), F.col("monthly_installment"), params).alias(
            "last_payment_pts"
        ),
        P.total_payment_pts(F.col("total_payment_received"), F.col("funded_amount"), params).alias(
            "total_payment_pts"
        ),
    )


def delinquency_points(delinq: DataFrame, params: ScoreParams = DEFAULT_PARAMS) -> DataFrame:
    return delinq.select(
        "member_id", P.delinquency_pts(F.col("delinq_2yrs"), params).alias("delinq_pts")
    )


def record_points(detail: DataFrame, params: ScoreParams = DEFAULT_PARAMS) -> DataFrame:
    return detail.select(
        "member_id",
        P.public_record_pts(F.col("pub_rec"), params).alias("public_records_pts"),
        P.bankruptcy_pts(F.col("pub_rec_bankruptcies"), params).alias("public_bankruptcies_pts"),
        P.enquiry_pts(F.col("inq_last_6mths"), params).alias("enq_pts"),
    )


def _join_history(
    detail_pts: DataFrame, delinq_pts: DataFrame, payment_pts: DataFrame, params: ScoreParams
) -> DataFrame:
    if params.score_undelinquent:
        history = detail_pts.join(delinq_pts, "member_id", "left").fillna(
            params.excellent_rated_pts, subset=["delinq_pts"]
        )
    else:
        history = detail_pts.join(delinq_pts, "member_id")
    return history.join(payment_pts, "member_id")


def join_member_history(detail: DataFrame, delinq: DataFrame, payment_pts: DataFrame) -> DataFrame:
    """Three-way join on the member. Members without a delinquency row are not in the result."""
    return detail.join(delinq, "member_id").join(payment_pts, "member_id")


def score_defaulter_history(
    detail: DataFrame,
    delinq: DataFrame,
    payment_pts: DataFrame,
    bad: DataFrame | None = None,
    params: ScoreParams = DEFAULT_PARAMS,
    limits: SkewLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Payment points with the four points from delinquencies, records and enquiries."""
    joined = _join_history(
        _less_bad(record_points(detail, params), bad, limits),
        _less_heavy_bad(delinquency_points(delinq, params), bad, limits),
        payment_pts,
        params,
    )
    return joined.select("member_id", *PAYMENT_PTS, *DEFAULTER_PTS)


def customer_points(customers: DataFrame, params: ScoreParams = DEFAULT_PARAMS) -> DataFrame:
    """What scoring needs of a customer; fixed-width values only."""
    return customers.select(
        "member_id",
        P.home_pts(F.col("home_ownership"), params).alias("home_pts"),
        P.grade_pts(F.col("grade"), F.col("sub_grade"), params).alias("grade_pts"),
        "total_high_credit_limit",
    )


def loan_points(loans: DataFrame, params: ScoreParams = DEFAULT_PARAMS) -> DataFrame:
    return loans.select(
        "member_id",
        P.loan_status_pts(F.col("loan_status"), params).alias("loan_status_pts"),
        "funded_amount",
    )


def join_member_health(history: DataFrame, loans: DataFrame, customers: DataFrame) -> DataFrame:
    """Join back to loans and customers on the member only, not on the loan."""
    return history.join(loans, "member_id").join(customers, "member_id")


def _health(
    history: DataFrame, loan_pts: DataFrame, customer_pts: DataFrame, params: ScoreParams
) -> DataFrame:
    joined = join_member_health(history, loan_pts, customer_pts)
    credit = P.credit_limit_pts(F.col("funded_amount"), F.col("total_high_credit_limit"), params)
    return joined.withColumn("credit_limit_pts", credit).select(
        "member_id", *PAYMENT_PTS, *DEFAULTER_PTS, *HEALTH_PTS
    )


def score_financial_health(
    history: DataFrame,
    loans: DataFrame,
    customers: DataFrame,
    bad: DataFrame | None = None,
    params: ScoreParams = DEFAULT_PARAMS,
    limits: SkewLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """History points with the four points from loan status, home, credit limit and grade."""
    kept = _less_bad(loan_points(loans, params), bad, limits)
    customer_pts = _less_heavy_bad(customer_points(customers, params), bad, limits)
    return _health(history, kept, customer_pts, params)


def _total(columns: tuple[str, ...]):
    total = F.col(columns[0])
    for c in columns[1:]:
        total = total + F.col(c)
    return total


def score_components(points: DataFrame, params: ScoreParams = DEFAULT_PARAMS) -> DataFrame:
    """Weighted sums, in exact decimal arithmetic."""
    return points.select(
        "member_id",
        (_total(PAYMENT_PTS) * F.lit(params.payment_weight)).alias("payment_history_pts"),
        (_total(DEFAULTER_PTS) * F.lit(params.defaulter_weight)).alias("defaulters_history_pts"),
        (_total(HEALTH_PTS) * F.lit(params.health_weight)).alias("financial_health_pts"),
    )


def loan_score(components: DataFrame) -> DataFrame:
    """Sum of the components; a NULL in any of them gives a NULL score."""
    score = (
        F.col("payment_history_pts") + F.col("defaulters_history_pts") + F.col("financial_health_pts")
    )
    return components.withColumn("loan_score", score)


def loan_final_grade(scored: DataFrame, params: ScoreParams = DEFAULT_PARAMS) -> DataFrame:
    return scored.withColumn("loan_final_grade", P.final_grade(F.col("loan_score"), params))


def finish_score(points: DataFrame, params: ScoreParams = DEFAULT_PARAMS) -> DataFrame:
    return loan_final_grade(loan_score(score_components(points, params)), params)


def score_points(
    tables: Mapping[str, DataFrame],
    bad: DataFrame | None = None,
    params: ScoreParams = DEFAULT_PARAMS,
    limits: SkewLimits = DEFAULT_LIMITS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """All points of each loan, from ``customers, loans, repayments, delinq, detail``.

    With a ``bad`` list its members are removed; ``counts`` are known rows per member and table, see
    :mod:`ledgerlark.operators.member_counts`, without which heavy members are counted. Without a list, the members repeated in customers,
    delinq or detail are: every scored member then has exactly one row in each of the three, so
    reducing each to its unique rows (one aggregation over fixed-width points, partitioned by member
    for all joins after it) gives the same members without a list, and no member join can fan out
    on those sides.
    """
    customers, loans, repayments, delinq, detail = (
        tables[n] for n in ("customers", "loans", "repayments", "delinq", "detail")
    )
    if bad is not None:
        return _points_with_list(tables, bad, params, limits, counts)

    detail_pts = unique_rows(record_points(detail, params))
    delinq_pts = unique_rows(delinquency_points(delinq, params))
    if params.score_undelinquent:
        # A member repeated in delinq is bad, not merely undelinquent.
        counts = delinq.groupBy("member_id").agg(F.count(F.lit(1)).alias("_n"))
        detail_pts = detail_pts.join(counts.where("_n > 1"), "member_id", "left_anti")
    customer_pts = unique_rows(customer_points(customers, params))
    # A member with many loans has as many detail rows, so it is repeated and gets no score. The
    # heaviest of these leave before the loans are shuffled.
    kept = drop_heavy(loans, detail, "member_id", limits)
    payment = score_payment_history(kept, repayments, None, params, limits)
    history = _join_history(detail_pts, delinq_pts, payment, params)
    return _health(history, loan_points(kept, params), customer_pts, params)


def _points_with_list(
    tables: Mapping[str, DataFrame],
    bad: DataFrame,
    params: ScoreParams,
    limits: SkewLimits,
    counts: DataFrame | None,
) -> DataFrame:
    """Points without the members of ``bad``, any of whom may hold a large share of any table.

    Every member join is an inner one with the records, so the list is removed as a whole from these only;
    from the other tables only its heavy members are. What is left joins on the member alone: a heavy member
    that is not listed is dealt out over slices.
    """
    sides = ("detail", "delinq", "loans", "customers")
    known = {
        n: key_counts(tables[n], "member_id") if counts is None
        else counts.where(F.col(n) > 0).select("member_id", F.col(n).alias("n"))
        for n in sides
    }

    def less_heavy(name: str, df: DataFrame) -> DataFrame:
        return drop_heavy(df, tables[name], "member_id", limits, bad, known[name])

    loans = less_heavy("loans", tables["loans"])
    payment = score_payment_history(loans, tables["repayments"], None, params, limits)
    delinq_pts = less_heavy("delinq", delinquency_points(tables["delinq"], params))
    parts = {
        "detail": anti_join_bad(record_points(tables["detail"], params), bad, "member_id", limits, known["detail"]),
        "delinq": delinq_pts,
        "loans": loan_points(loans, params),
        "customers": less_heavy("customers", customer_points(tables["customers"], params)),
    }
    if params.score_undelinquent:
        # The only outer join: records that have no delinquency row keep the best points.
        both = sliced_star_join(
            parts["detail"], [parts.pop("delinq")], "member_id", "left", limits,
            counts=[known["detail"], known["delinq"]], base_keys=tables["detail"],
        )
        parts["detail"] = both.fillna(params.excellent_rated_pts, subset=["delinq_pts"])
    joined = sliced_star_join(
        payment, list(parts.values()), "member_id", "inner", limits,
        counts=[known["loans"], *(known[n] for n in parts)], base_keys=loans,
    )
    credit = P.credit_limit_pts(F.col("funded_amount"), F.col("total_high_credit_limit"), params)
    return joined.withColumn("credit_limit_pts", credit).select(
        "member_id", *PAYMENT_PTS, *DEFAULTER_PTS, *HEALTH_PTS
    )


def score_pipeline(
    tables: Mapping[str, DataFrame],
    bad: DataFrame | None = None,
    params: ScoreParams = DEFAULT_PARAMS,
    limits: SkewLimits = DEFAULT_LIMITS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Loan scores and final grades from the five clean tables, see :func:`score_points`."""
    return finish_score(score_points(tables, bad, params, limits, counts), params)


def score_single_pass(raw_with_key: DataFrame, params: ScoreParams = DEFAULT_PARAMS) -> DataFrame:
    """The score straight from the raw file with its member key, in one shuffle by member.

    The raw file has one row per loan and every entity is a projection of it, so a member with
    several raw rows is repeated in the detail table and gets no score, and a scored member's
    customer, loan, repayment and delinquency rows all come from its one raw row. The points and
    the outcome of each cleaning filter are worked out per row, then one aggregation keeps the
    members with a single row. Needs ``id`` to be unique, as the raw file's key: see
    :func:`ledgerlark.operators.quality.check_unique`.
    """
    row = K.rename_customers(all_entities(raw_with_key))
    row = K.clean_counts(K.repair_total_payment(row), ["delinq_2yrs", *S.RECORD_COUNTS])
    required = [*S.LOAN_REQUIRED, *S.REPAYMENT_REQUIRED, "annual_income", "loan_id"]
    complete = F.lit(True)
    for c in required:
        complete = complete & F.col(c).isNotNull()
    paid = F.col("total_payment_received") != 0.0
    delinquent = (F.col("delinq_2yrs") > 0) | (F.col("mths_since_last_delinq") > 0)
    usable = complete & paid
    if not params.score_undelinquent:
        usable = usable & delinquent
    # Widened as in the warehouse, so that points compare the same double values.
    wide = widen(row.withColumn("_usable", F.coalesce(usable, F.lit(False))))
    paid_pts = P.last_payment_pts(F.col("last_payment_amount"), F.col("monthly_installment"), params)
    total_pts = P.total_payment_pts(F.col("total_payment_received"), F.col("funded_amount"), params)
    credit = P.credit_limit_pts(F.col("funded_amount"), F.col("total_high_credit_limit"), params)
    points = wide.select(
        "member_id",
        "_usable",
        paid_pts.alias("last_payment_pts"),
        total_pts.alias("total_payment_pts"),
        P.delinquency_pts(F.col("delinq_2yrs"), params).alias("delinq_pts"),
        P.public_record_pts(F.col("pub_rec"), params).alias("public_records_pts"),
        P.bankruptcy_pts(F.col("pub_rec_bankruptcies"), params).alias("public_bankruptcies_pts"),
        P.enquiry_pts(F.col("inq_last_6mths"), params).alias("enq_pts"),
        P.loan_status_pts(F.col("loan_status"), params).alias("loan_status_pts"),
        P.home_pts(F.col("home_ownership"), params).alias("home_pts"),
        credit.alias("credit_limit_pts"),
        P.grade_pts(F.col("grade"), F.col("sub_grade"), params).alias("grade_pts"),
    )
    return finish_score(unique_rows(points).where("_usable").drop("_usable"), params)
