"""

Queries of the cleaning jobs start from the raw rows; queries of the warehouse jobs read the five
clean tables, which are written once per session and input folder, as those jobs do.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixture
from checks.oracle import UNIFIED_INTS, UNIFIED_SUMS
from ledgerlark import schema as S
from ledgerlark.functions import points as P
from ledgerlark.functions.points import ScoreParams
from ledgerlark.operators import clean as K
from ledgerlark.operators import identity as I
from ledgerlark.operators import member_counts as N
from ledgerlark.operators import quality as Q
from ledgerlark.operators import scoring as R
from ledgerlark.operators import sketches as H
from ledgerlark.operators.observed import Profile
from ledgerlark.operators.skew import SkewLimits
from ledgerlark.plans import dimension as D
from ledgerlark.plans import factorised as X
from ledgerlark.plans import marts as M
from ledgerlark.plans import unified as U
from ledgerlark.plans.pipeline import write_tables
from ledgerlark.session import stored_bytes, tune
from ledgerlark.sources import readers, writers
from ledgerlark.sources.releases import Release
from ledgerlark.sources.scratch import materialize, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

# --- inputs ------------------------------------------------------------------

_TABLES: dict[tuple[str, str], dict[str, DataFrame]] = {}
_NEW: dict[tuple[str, str], dict[str, DataFrame]] = {}
_SCORES: dict[tuple[str, str], DataFrame] = {}
_COUNTS: dict[tuple[str, str], str] = {}


def _session_key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return spark.sparkContext.applicationId, sf_dir


def raw_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [f"{sf_dir}/{name}.parquet" for name in ("orders", "customer")]
    return fixture.raw_loans(tune(spark, stored_bytes(spark, *paths)), sf_dir)


def keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.member_identity(raw_loans(spark, sf_dir))


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five clean tables, written to the scratch folder on first use."""
    key = _session_key(spark, sf_dir)
    if key not in _TABLES:
        base = scratch_path(spark, "tables")
        _TABLES[key] = write_tables(raw_loans(spark, sf_dir), lambda name: f"{base}/{name}")
    return _TABLES[key]


def members(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three tables that are searched for repeated members."""
    t = tables(spark, sf_dir)
    return {n: t[n] for n in ("customers", "delinq", "detail")}


def without_bad(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The clean tables with the three member tables less repeated members, and the ``bad`` list.

    Written on first use, as the quality job does for the scoring job.
    """
    key = _session_key(spark, sf_dir)
    if key not in _NEW:
        three = members(spark, sf_dir)
        repeated = materialize(Q.repeated_members(three), "repeated_members")
        new = {n: materialize(Q.without_repeated(n, three, repeated=repeated), f"{n}_new") for n in three}
        bad = materialize(repeated.select(Q.MEMBER), "bad_members")
        _NEW[key] = {**tables(spark, sf_dir), **new, "bad": bad}
    return _NEW[key]


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows per member, after two raw files were added one after the other.

    The second file has every loan of an odd id and, again, those divisible by 20.
    """
    key = _session_key(spark, sf_dir)
    if key not in _COUNTS:
        prefix, folder = f"counts_{uuid.uuid4().hex}_", scratch_path(spark, "counts")
        raw = keyed(spark, sf_dir)
        even, repeated = F.expr("cast(id as bigint) % 2 = 0"), F.expr("cast(id as bigint) % 20 = 0")
        for file, part in (("first.csv", even & ~repeated), ("second.csv", ~even | repeated)):
            N.add_file(spark, raw.where(part), file, prefix, folder)
        _COUNTS[key] = prefix
    return spark.table(f"{_COUNTS[key]}{N.COUNTS}")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written score table, which the score marts read."""
    key = _session_key(spark, sf_dir)
    if key not in _SCORES:
        _SCORES[key] = materialize(R.score_pipeline(tables(spark, sf_dir)), "loan_score")
    return _SCORES[key]


def _plain(df: DataFrame) -> DataFrame:
    """Result as compared: no ingest time, whole numbers as bigint, fractions as double."""
    df = readers.widen(df.drop("ingest_date"))
    return df.select(
        *(F.col(n).cast("double").alias(n) if t.startswith("decimal") else F.col(n) for n, t in df.dtypes)
    )


def on_keyed(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: _plain(step(keyed(spark, sf_dir)))


def on_customers(step: Callable[[DataFrame], DataFrame]) -> Query:
    return on_keyed(lambda df: step(I.customers_entity(df)))


def on_loans(step: Callable[[DataFrame], DataFrame]) -> Query:
    return on_keyed(lambda df: step(I.loans_entity(df)))


def on_kept_loans(step: Callable[[DataFrame], DataFrame]) -> Query:
    return on_loans(lambda df: step(K.drop_null_rows(df, S.LOAN_REQUIRED)))


def on_repayments(step: Callable[[DataFrame], DataFrame]) -> Query:
    return on_keyed(lambda df: step(I.repayments_entity(df)))


def on_kept_repayments(step: Callable[[DataFrame], DataFrame]) -> Query:
    return on_repayments(lambda df: step(K.drop_null_rows(df, S.REPAYMENT_REQUIRED)))


def on_defaulters(step: Callable[[DataFrame], DataFrame]) -> Query:
    return on_keyed(lambda df: step(I.defaulters_entity(df)))


def on_tables(step: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, sf_dir: _plain(step(tables(spark, sf_dir)))


def on_members(step: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, sf_dir: _plain(step(members(spark, sf_dir)))


def on_good(step: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, sf_dir: _plain(step(without_bad(spark, sf_dir)))


def on_counts(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: _plain(step(counts(spark, sf_dir)))


def on_scores(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: _plain(step(scores(spark, sf_dir)))


# --- scans and sinks: write to the scratch folder, read back -----------------


def scan_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "defaulters_csv")
    writers.write_csv(I.split_defaulters(keyed(spark, sf_dir)), path)
    return _plain(readers.read_csv_inferred(spark, path))


def scan_csv_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "loans_csv")
    writers.write_csv(I.split_loans(keyed(spark, sf_dir)), path)
    return _plain(readers.read_csv_positional(spark, path, S.LOANS_DDL))


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "customers")
    writers.write_parquet(tables(spark, sf_dir)["customers"], path)
    return _plain(readers.read_parquet(spark, path))


def _table_round_trip(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    name = f"ledgerlark_{label}_{uuid.uuid4().hex}"
    writers.write_table(df, name, options={"path": scratch_path(spark, label)})
    return _plain(readers.read_table(spark, name))


def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table_round_trip(spark, tables(spark, sf_dir)["delinq"], "delinq")


def sink_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table_round_trip(spark, tables(spark, sf_dir)["detail"], "detail")


def sink_csv_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "bad_members_csv")
    writers.write_csv_single(Q.bad_members(members(spark, sf_dir)), path)
    return readers.read_csv_positional(spark, path, "member_id string")


def sink_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "loans_clean_csv")
    loans = tables(spark, sf_dir)["loans"]
    writers.write_csv(loans, path)
    return _plain(spark.read.schema(loans.schema).csv(path, header=True))


def sink_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "repayments")
    writers.write_parquet(tables(spark, sf_dir)["repayments"], path)
    return _plain(readers.read_parquet(spark, path))


def sink_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two releases of the loans; readers see the second one after its switch."""
    prefix, folder = f"ledgerlark_{uuid.uuid4().hex}_", scratch_path(spark, "releases")
    loans = tables(spark, sf_dir)["loans"]
    for rows in (loans.where("loan_term_years = 3"), loans):
        release = Release(spark, prefix, folder)
        release.write("loans", writers.add_issue_year(rows), partition_by=["issue_year"])
        release.switch()
    return _plain(spark.table(f"{prefix}loans"))


def profile_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles taken along while the clean tables are written."""
    base, profile = scratch_path(spark, "profiled"), Profile()
    write_tables(raw_loans(spark, sf_dir), lambda name: f"{base}/{name}", profile=profile)
    return profile.rows(spark)


def mart_cube(t: dict[str, DataFrame]) -> DataFrame:
    """The seven marts over loans, one below the other, from the one-pass cube."""
    cube = materialize(M.mart_cube(t["loans"], t["customers"]), "cube")
    out = None
    for name, df in M.marts_of(cube).items():
        column = (M.SHARES | M.RATES)[name]
        rate = "share" if name in M.SHARES else "default_rate"
        one = df.select(
            F.lit(name).alias("mart"), F.col(column).cast("string").alias("value"), "loans", F.col(rate).alias("rate")
        )
        out = one if out is None else out.unionByName(one)
    return out


def sink_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"ledgerlark_loans_{uuid.uuid4().hex}"
    loans = tables(spark, sf_dir)["loans"]
    writers.write_partitioned(loans, name, path=scratch_path(spark, "loans_partitioned"))
    return _plain(readers.read_table(spark, name))


# --- wide table --------------------------------------------------------------


def join_unified(t: dict[str, DataFrame]) -> DataFrame:
    """The whole join, counted by which sides are present."""

    def present(column: str):
        return F.col(column).isNotNull()

    return (
        U.join_unified(t)
        .groupBy(
            present("loan_id").alias("has_loan"),
            present(U.REPAYMENT_MARK).alias(U.REPAYMENT_MARK),
            present(U.DELINQ_MARK).alias(U.DELINQ_MARK),
            present(U.DETAIL_MARK).alias(U.DETAIL_MARK),
        )
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.countDistinct("member_id").alias("members"),
            F.count("loan_id").alias("loan_rows"),
        )
    )


def unified_select(t: dict[str, DataFrame]) -> DataFrame:
    """The 35 columns over the whole join, summed up per grade and state."""
    return (
        U.unified_select(U.join_unified(t))
        .groupBy("grade", "address_state")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *(F.count(c).alias(c) for c in ("loan_id", "last_payment_date", "next_payment_date")),
            *(F.sum(F.col(c).cast(M.MONEY)).alias(c) for c in UNIFIED_SUMS),
            *(F.sum(c).alias(c) for c in UNIFIED_INTS),
        )
    )


def unified_view(t: dict[str, DataFrame]) -> DataFrame:
    """The dashboard's view, used through SQL text."""
    U.unified_view(U.unified_table(t), "customers_loan_v")
    return t["customers"].sparkSession.sql(
        "SELECT loan_status, loan_purpose, count(*) AS n, count(DISTINCT member_id) AS members, "
        "count(loan_id) AS with_loan FROM customers_loan_v GROUP BY loan_status, loan_purpose"
    )


def unified_factorised(slice_rows: int) -> Query:
    """The wide table through the view over its stored factors."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        name = f"ledgerlark_factors_{uuid.uuid4().hex}"
        factors = X.factorised(tables(spark, sf_dir), slice_rows, counts=counts(spark, sf_dir))
        writers.write_table(factors, name, options={"path": scratch_path(spark, "factors")})
        return _plain(X.register_wide_view(spark, name, f"{name}_wide"))

    return query


# --- sketches and history ------------------------------------------------------


def distinct_members_sketched(t: dict[str, DataFrame]) -> DataFrame:
    """Exact members per year and over all years, and whether the merged states' estimates are near them."""
    loans = writers.add_issue_year(t["loans"]).select("issue_year", "member_id")
    states = materialize(H.member_sketches(loans, "issue_year"), "sketches")
    whole = H.merge_sketches(states).withColumn("issue_year", F.lit(None).cast("int"))
    estimated = H.estimated_members(states.unionByName(whole))
    exact = loans.groupBy("issue_year").agg(F.countDistinct("member_id").alias("members"))
    exact = exact.unionByName(
        Q.count_distinct_members(loans).select(
            F.lit(None).cast("int").alias("issue_year"), F.col("distinct_members").alias("members")
        )
    )
    joined = exact.alias("x").join(estimated.alias("e"), F.col("x.issue_year").eqNullSafe(F.col("e.issue_year")))
    # Four standard errors of the state's size.
    near = F.abs(F.col("e.members") - F.col("x.members")) <= F.greatest(F.lit(1.0), F.col("x.members") * 0.033)
    return joined.select("x.issue_year", "x.members", near.alias("near"))


SKETCH_LIMITS = SkewLimits(max_keys=1000, min_rows=3)


def heavy_members_sketched(t: dict[str, DataFrame]) -> DataFrame:
    return H.sketched_heavy_keys(t["loans"], "member_id", SKETCH_LIMITS)


def dim_customer_history(t: dict[str, DataFrame]) -> DataFrame:
    """The customer dimension after two files, the second of which changes some members and lacks others."""
    customers = t["customers"]
    moved = F.when(F.col("address_state") == "CA", F.lit("WA")).otherwise(F.col("address_state"))
    second = customers.where("annual_income >= 50000").withColumn("address_state", moved)
    first = D.first_load(customers.where("annual_income < 100000"), 1)
    return D.merge_load(materialize(first, "dimension"), second, 2)


# --- scoring -----------------------------------------------------------------

ALTERNATIVE_PARAMS = ScoreParams(
    excellent_rated_pts=900, good_rated_pts=450, very_bad_rated_pts=50,
    very_good_grade_pts=2600, unacceptable_grade_pts=700,
)


def payment_history(t: dict[str, DataFrame]) -> DataFrame:
    return R.score_payment_history(t["loans"], t["repayments"], t["bad"])


def defaulter_history(t: dict[str, DataFrame]) -> DataFrame:
    return R.score_defaulter_history(t["detail"], t["delinq"], payment_history(t))


def financial_health(t: dict[str, DataFrame]) -> DataFrame:
    return R.score_financial_health(defaulter_history(t), t["loans"], t["customers"], t["bad"])


def join_member_health(t: dict[str, DataFrame]) -> DataFrame:
    loans = t["loans"].select("member_id", "loan_id", "loan_status", "funded_amount")
    customers = t["customers"].select(
        "member_id", "home_ownership", "grade", "sub_grade", "total_high_credit_limit"
    )
    return R.join_member_health(defaulter_history(t), Q.anti_join_bad(loans, t["bad"]), customers)


def loan_payment_points(column: str) -> Query:
    rule = {"last_payment_pts": P.last_payment_pts, "total_payment_pts": P.total_payment_pts}[column]
    inputs = {
        "last_payment_pts": ("last_payment_amount", "monthly_installment"),
        "total_payment_pts": ("total_payment_received", "funded_amount"),
    }[column]
    return on_tables(
        lambda t: R.join_loan_repayment(t["loans"], t["repayments"]).select(
            "loan_id", rule(*(F.col(c) for c in inputs)).alias(column)
        )
    )


def score_single_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = Q.check_unique(raw_loans(spark, sf_dir), "id")
    return _plain(R.score_single_pass(I.member_identity(raw)))


def score_with_bad_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unstripped tables, the stored bad list and the stored counts, as a later job finds them."""
    bad = without_bad(spark, sf_dir)["bad"]
    return _plain(R.score_pipeline(tables(spark, sf_dir), bad, counts=counts(spark, sf_dir)))


def new_from_counts(name: str) -> Query:
    """A table less the repeated members, by the list that the stored counts give."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        stored, t = counts(spark, sf_dir), tables(spark, sf_dir)
        bad = N.bad_members_of(stored)
        return _plain(Q.anti_join_bad(t[name], bad, counts=N.rows_per_member(stored, name)))

    return query


def pts_credit_limit(t: dict[str, DataFrame]) -> DataFrame:
    points = P.credit_limit_pts(F.col("funded_amount"), F.col("total_high_credit_limit"))
    joined = Q.anti_join_bad(t["loans"], t["bad"]).join(t["customers"], "member_id")
    return joined.select("loan_id", points.alias("credit_limit_pts"))


QUERIES: dict[str, Query] = {
    # 2.1 scans, sources, sinks
    "scan_csv_inferred": scan_csv_inferred,
    "scan_csv_positional": scan_csv_positional,
    "scan_parquet": scan_parquet,
    "scan_table": scan_table,
    "sink_csv_single": sink_csv_single,
    "sink_csv": sink_csv,
    "sink_parquet": sink_parquet,
    "sink_table": sink_table,
    "sink_partitioned": sink_partitioned,
    "sink_release": sink_release,
    "star_schema": on_tables(lambda t: U.star_summary(U.star_schema(t))),
    "star_schema_dim_customer": on_tables(lambda t: U.star_schema(t)["dim_customer"]),
    "star_schema_dim_issue_month": on_tables(lambda t: U.star_schema(t)["dim_issue_month"]),
    "star_schema_fact_loan": on_tables(lambda t: U.star_schema(t)["fact_loan"]),
    "dim_customer_history": on_tables(dim_customer_history),
    "unified_view": on_tables(unified_view),
    # 2.2 projections
    "member_identity": on_keyed(lambda df: df),
    "split_customers": on_keyed(I.split_customers),
    "split_loans": on_keyed(I.split_loans),
    "split_repayments": on_keyed(I.split_repayments),
    "split_defaulters": on_keyed(I.split_defaulters),
    "rename_customers": on_customers(K.rename_customers),
    "add_ingest_ts": lambda spark, sf_dir: readers.widen(
        K.add_ingest_ts(I.loans_entity(keyed(spark, sf_dir)), datetime(2020, 1, 1)).withColumn(
            "ingest_date", F.date_format("ingest_date", "yyyy-MM-dd HH:mm:ss")
        )
    ),
    "unified_select": on_tables(unified_select),
    "delinquency_select": on_defaulters(
        lambda df: K.delinquency_select(K.clean_counts(df, ["delinq_2yrs"]))
    ),
    "records_detail_select": on_defaulters(
        lambda df: K.records_detail_select(K.clean_counts(df, S.RECORD_COUNTS))
    ),
    # 2.3 filters, joins, set operations
    "filter_not_null": on_customers(lambda df: K.filter_not_null(K.rename_customers(df))),
    "drop_null_rows": on_kept_loans(lambda df: df),
    "drop_null_rows_repayments": on_kept_repayments(lambda df: df),
    "filter_inconsistent_zero": on_kept_repayments(K.filter_inconsistent_zero),
    "filter_paid": on_kept_repayments(lambda df: K.filter_paid(K.repair_total_payment(df))),
    "filter_delinquent": on_defaulters(
        lambda df: K.filter_delinquent(K.clean_counts(df, ["delinq_2yrs"]))
    ),
    "filter_records_enq": on_defaulters(K.records_enquiries),
    "filter_key_prefix": on_keyed(
        lambda df: Q.filter_key_prefix(df, S.EMPTY_IDENTITY_PREFIX, "name_sha2")
    ),
    "filter_key_equals": on_kept_repayments(
        lambda df: Q.filter_key_equals(K.repair_total_payment(df), "1064")
    ),
    "filter_too_long": on_customers(
        lambda df: K.filter_too_long(
            K.impute_emp_length(K.clean_emp_length(K.distinct_customers(df)))
        )
    ),
    "filter_zero_date": on_kept_repayments(
        lambda df: K.filter_zero_date(K.filter_paid(K.repair_total_payment(df)))
    ),
    "join_loan_repayment": on_tables(lambda t: R.join_loan_repayment(t["loans"], t["repayments"])),
    "join_member_history": on_good(
        lambda t: R.join_member_history(t["detail"], t["delinq"], payment_history(t))
    ),
    "join_member_health": on_good(join_member_health),
    "join_unified": on_tables(join_unified),
    "anti_join_bad": on_good(lambda t: Q.anti_join_bad(t["loans"], t["bad"])),
    "union_bad": on_members(Q.union_bad),
    "union_bad_distinct": on_members(lambda t: Q.union_bad(t).distinct()),
    # 2.4 aggregations
    "count_rows": on_keyed(Q.count_rows),
    "count_distinct_members": on_keyed(lambda df: Q.count_distinct_members(df, "name_sha2")),
    "distinct_members_sketched": on_tables(distinct_members_sketched),
    "heavy_members_sketched": on_tables(heavy_members_sketched),
    "profile_nulls": on_repayments(Q.profile_nulls),
    "profile_rules": on_kept_repayments(lambda df: Q.profile_rules(df, Q.repayment_rules())),
    "profile_rules_customers": on_customers(
        lambda df: Q.profile_rules(Q.distinct_rows(K.rename_customers(df)), Q.customer_rules())
    ),
    "profile_observed": profile_observed,
    "rows_null_amount": on_loans(lambda df: K.rows_null(df, "loan_amount")),
    "distinct_rows": on_customers(lambda df: Q.distinct_rows(K.rename_customers(df))),
    "distinct_values": on_tables(lambda t: Q.distinct_values(t["customers"], "address_state")),
    "value_counts": on_kept_loans(lambda df: Q.value_counts(df, "loan_purpose")),
    "key_multiplicity": on_tables(lambda t: Q.key_multiplicity(t["customers"])),
    "key_multiplicity_delinq": on_counts(lambda c: N.multiplicity_of(c, "delinq")),
    "key_multiplicity_detail": on_counts(lambda c: N.multiplicity_of(c, "detail")),
    "key_multiplicity_customers_new": on_good(lambda t: Q.key_multiplicity(t["customers"])),
    "members_repeated": on_keyed(lambda df: Q.members_repeated(df, "name_sha2")),
    "duplicate_keys": on_tables(lambda t: Q.duplicate_keys(t["customers"])),
    "duplicate_keys_delinq": on_counts(lambda c: N.repeated_in(c, "delinq")),
    "duplicate_keys_detail": on_counts(lambda c: N.repeated_in(c, "detail")),
    "member_counts": on_counts(lambda c: c),
    "avg_emp_length": on_customers(
        lambda df: K.avg_emp_length(K.clean_emp_length(K.distinct_customers(df)))
    ),
    # 2.5 sorts, limits
    "sort_counts": on_defaulters(
        lambda df: Q.sort_counts(df.groupBy("delinq_2yrs").agg(F.count(F.lit(1)).alias("total")))
    ),
    "top_k_members": on_tables(lambda t: Q.top_k_members(t["detail"], 20)),
    # 2.6 cleaning
    "clean_emp_length": on_customers(lambda df: K.clean_emp_length(K.distinct_customers(df))),
    "impute_emp_length": on_customers(
        lambda df: K.impute_emp_length(K.clean_emp_length(K.distinct_customers(df)))
    ),
    "clean_state": on_customers(lambda df: K.clean_state(K.rename_customers(df))),
    "clean_term": on_kept_loans(K.clean_term),
    "clean_purpose": on_kept_loans(K.clean_purpose),
    "repair_total_payment": on_kept_repayments(K.repair_total_payment),
    "null_zero_dates": on_kept_repayments(
        lambda df: K.null_zero_dates(K.filter_paid(K.repair_total_payment(df)))
    ),
    "clean_counts": on_defaulters(
        lambda df: K.clean_counts(df, ["delinq_2yrs", *S.RECORD_COUNTS])
    ),
    "clean_customers": on_customers(K.clean_customers),
    "clean_loans": on_loans(K.clean_loans),
    "clean_repayments": on_repayments(K.clean_repayments),
    "clean_delinquency": on_defaulters(K.clean_delinquency),
    "clean_records_detail": on_defaulters(K.clean_records_detail),
    # 2.7 scoring
    "score_params": on_tables(lambda t: R.score_pipeline(t, params=ALTERNATIVE_PARAMS)),
    "pts_last_payment": loan_payment_points("last_payment_pts"),
    "pts_total_payment": loan_payment_points("total_payment_pts"),
    "score_payment_history": on_good(payment_history),
    "pts_delinquency": on_tables(lambda t: R.delinquency_points(t["delinq"])),
    "pts_public_records": on_tables(
        lambda t: R.record_points(t["detail"]).select("member_id", "public_records_pts")
    ),
    "pts_bankruptcies": on_tables(
        lambda t: R.record_points(t["detail"]).select("member_id", "public_bankruptcies_pts")
    ),
    "pts_enquiries": on_tables(lambda t: R.record_points(t["detail"]).select("member_id", "enq_pts")),
    "score_defaulter_history": on_good(defaulter_history),
    "pts_loan_status": on_tables(
        lambda t: t["loans"].select(
            "loan_id", P.loan_status_pts(F.col("loan_status")).alias("loan_status_pts")
        )
    ),
    "pts_home": on_tables(
        lambda t: R.customer_points(t["customers"]).select("member_id", "home_pts")
    ),
    "pts_credit_limit": on_good(pts_credit_limit),
    "pts_grade": on_tables(
        lambda t: R.customer_points(t["customers"]).select("member_id", "grade_pts")
    ),
    "score_financial_health": on_good(financial_health),
    "score_components": on_good(lambda t: R.score_components(financial_health(t))),
    "loan_score": on_good(lambda t: R.loan_score(R.score_components(financial_health(t)))),
    "loan_final_grade": on_good(lambda t: R.finish_score(financial_health(t))),
    "score_pipeline": on_tables(R.score_pipeline),
    "score_with_bad_list": score_with_bad_list,
    "score_single_pass": score_single_pass,
    # 2.8 dashboard
    "mart_status_share": on_tables(lambda t: M.mart_status_share(t["loans"])),
    "mart_grade_share": on_tables(lambda t: M.mart_grade_share(t["loans"], t["customers"])),
    "mart_purpose_share": on_tables(lambda t: M.mart_purpose_share(t["loans"])),
    "mart_cube": on_tables(mart_cube),
    "mart_issue_trend": on_tables(lambda t: M.mart_issue_trend(t["loans"])),
    "mart_repayment_trend": on_tables(lambda t: M.mart_repayment_trend(t["repayments"])),
    "mart_default_rate_state": on_tables(
        lambda t: M.mart_default_rate_state(t["loans"], t["customers"])
    ),
    "mart_default_rate_home": on_tables(
        lambda t: M.mart_default_rate_home(t["loans"], t["customers"])
    ),
    "mart_default_rate_emp": on_tables(lambda t: M.mart_default_rate_emp(t["loans"], t["customers"])),
    "mart_default_rate_income": on_tables(
        lambda t: M.mart_default_rate_income(t["loans"], t["customers"])
    ),
    "mart_score_histogram": on_scores(M.mart_score_histogram),
    "mart_risk_category": on_scores(M.mart_risk_category),
    # 2.9 quality composites
    "bad_members": on_members(Q.bad_members),
    "customers_new": on_members(lambda t: Q.without_repeated("customers", t)),
    "delinq_new": on_members(lambda t: Q.without_repeated("delinq", t)),
    "detail_new": on_members(lambda t: Q.without_repeated("detail", t)),
    "bad_members_from_counts": on_counts(N.bad_members_of),
    "customers_new_from_counts": new_from_counts("customers"),
    "detail_new_from_counts": new_from_counts("detail"),
    "verify_dedup": on_members(lambda t: Q.verify_dedup(Q.without_repeated("customers", t))),
    "unified_table": on_tables(U.unified_table),
    "unified_factorised": unified_factorised(X.SLICE_ROWS),
    "unified_factorised_sliced": unified_factorised(20),
    "unified_table_loan_grain": on_tables(lambda t: U.unified_table(t, grain="loan")),
}
