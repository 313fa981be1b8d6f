"""The whole pipeline in one session, or some of its stages from stored tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ledgerlark.functions.points import DEFAULT_PARAMS, ScoreParams
from ledgerlark.operators import clean as K
from ledgerlark.operators import identity as I
from ledgerlark.operators import member_counts as N
from ledgerlark.operators import quality as Q
from ledgerlark.operators.observed import Profile, ride_clean, ride_distinct_customers, ride_raw
from ledgerlark.operators.scoring import score_pipeline
from ledgerlark.plans import factorised as X
from ledgerlark.plans import marts as M
from ledgerlark.plans import unified as U
from ledgerlark.sources.readers import widen
from ledgerlark.sources.releases import Release
from ledgerlark.sources.writers import add_issue_year, write_csv, write_parquet, write_partitioned, write_table

CLEAN_TABLES = ("customers", "loans", "repayments", "delinq", "detail")
SEARCHED = N.SEARCHED


def clean_tables(
    keyed: DataFrame, ingest_at: datetime | None = None, profile: Profile | None = None
) -> dict[str, DataFrame]:
    """The five clean tables of a raw loan frame with its member key, lazily."""
    defaulters = I.defaulters_entity(keyed)
    customers = K.rename_customers(I.customers_entity(keyed)).distinct()
    if profile is not None:
        customers = ride_distinct_customers(profile, customers)
    tables = {
        "customers": K.finish_customers(K.filter_not_null(customers), ingest_at),
        "loans": K.clean_loans(I.loans_entity(keyed), ingest_at),
        "repayments": K.clean_repayments(I.repayments_entity(keyed), ingest_at),
        "delinq": K.clean_delinquency(defaulters),
        "detail": K.clean_records_detail(defaulters),
    }
    if profile is not None:
        tables = {name: ride_clean(profile, name, df) for name, df in tables.items()}
    return tables


def _stored(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    write_parquet(df, path)
    return spark.read.schema(df.schema).parquet(path)


def write_tables(
    raw: DataFrame,
    path_for: Callable[[str], str],
    ingest_at: datetime | None = None,
    profile: Profile | None = None,
) -> dict[str, DataFrame]:
    """Write the raw frame with its member key, then the five clean tables; return what was written.

    The keyed rows are written first so that CSV parsing and hashing happen once, not once per
    entity. Written tables also survive the loss of any executor. ``profile`` takes counts along.
    """
    spark = raw.sparkSession
    identified = I.member_identity(raw)
    keyed = _stored(
        spark, path_for("normalized"), identified if profile is None else ride_raw(profile, identified)
    )
    entities = clean_tables(keyed, ingest_at, profile)
    # The five writes do not depend on each other: submitted together, one fills the slots that the
    # last tasks of another leave free.
    with ThreadPoolExecutor(len(entities)) as pool:
        written = list(pool.map(lambda name: _stored(spark, path_for(name), entities[name]), entities))
    return {name: widen(df) for name, df in zip(entities, written, strict=True)}


# --- stages ----------------------------------------------------------------------


@dataclass
class Run:
    """A target folder, the options of a run and the tables it has read and written so far."""

    spark: SparkSession
    target: str
    raw: DataFrame | None = None
    params: ScoreParams = DEFAULT_PARAMS
    ingest_at: datetime | None = None
    wide: str = "factors"
    known: dict[str, DataFrame] = field(default_factory=dict)
    written: dict[str, DataFrame] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.target}/{name}"

    def add(self, tables: Mapping[str, DataFrame]) -> None:
        """Take in tables that were written to the folder."""
        self.written |= tables
        self.known |= tables

    def write(self, name: str, df: DataFrame) -> DataFrame:
        self.add({name: _stored(self.spark, self.path(name), df)})
        return self.known[name]

    def read(self, name: str) -> DataFrame:
        """A table of this run, or the one that an earlier run left in the folder."""
        if name not in self.known:
            stored = self.spark.read.parquet(self.path(name))
            self.known[name] = widen(stored) if name in CLEAN_TABLES else stored
        return self.known[name]

    def read_all(self, names: Iterable[str]) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in names}


def clean(run: Run) -> None:
    """Raw rows to the five clean tables, the members with records, and the profiles."""
    if run.raw is None:
        raise ValueError("the first stage needs the raw rows")
    profile = Profile()
    run.add(write_tables(run.raw, run.path, run.ingest_at, profile))
    run.write("profiles", profile.rows(run.spark))
    keyed = run.spark.read.parquet(run.path("normalized"))
    run.write("records_enquiries", K.records_enquiries(I.defaulters_entity(keyed)))


def count(run: Run) -> None:
    """Rows per member, counted once, and the lists that follow from them."""
    keyed = run.spark.read.parquet(run.path("normalized"))
    state = run.write(N.STATE, N.file_state(keyed))
    counts = run.write(N.COUNTS, N.member_counts(state))
    run.write("bad_members", N.bad_members_of(counts))
    for name in SEARCHED:
        run.write(f"bad_{name}", N.repeated_in(counts, name))


def quality(run: Run) -> None:
    """The three member tables less the members on the list."""
    counts, bad = run.read(N.COUNTS), run.read("bad_members")
    for name in SEARCHED:
        known = N.rows_per_member(counts, name)
        run.write(f"{name}_new", Q.anti_join_bad(run.read(name), bad, counts=known))


def wide(run: Run) -> None:
    """The wide table: its factors, or its rows, of the joins or one per loan."""
    tables, counts = run.read_all(CLEAN_TABLES), run.read(N.COUNTS)
    if run.wide == "factors":
        run.write("unified_factors", X.factorised(tables, counts=counts))
    elif run.wide != "none":
        run.write("unified", U.unified_table(tables, grain=run.wide))


def score(run: Run) -> None:
    """The loan score from the clean tables, the stored list and the stored counts."""
    tables, bad = run.read_all(CLEAN_TABLES), run.read("bad_members")
    run.write("loan_score", score_pipeline(tables, bad, run.params, counts=run.read(N.COUNTS)))


def marts(run: Run) -> None:
    """The star schema and the dashboard's tables."""
    tables = run.read_all(CLEAN_TABLES)
    for name, df in U.star_schema(tables).items():
        run.write(name, df)
    star = {name: run.read(name) for name in ("fact_loan", "dim_customer", "dim_issue_month")}
    run.write("star_summary", U.star_summary(star))
    cube = run.write("mart_cube", M.mart_cube(tables["loans"], tables["customers"]))
    for name, df in M.marts_of(cube).items():
        run.write(name, df)
    run.write("mart_issue_trend", M.mart_issue_trend(tables["loans"]))
    run.write("mart_repayment_trend", M.mart_repayment_trend(tables["repayments"]))
    run.write("mart_score_histogram", M.mart_score_histogram(run.read("loan_score")))
    run.write("mart_risk_category", M.mart_risk_category(run.read("loan_score")))


STAGES: Mapping[str, Callable[[Run], None]] = {
    "clean": clean, "count": count, "quality": quality, "wide": wide, "score": score, "marts": marts,
}


def run_stages(run: Run, stages: Iterable[str] = tuple(STAGES)) -> dict[str, DataFrame]:
    """Run stages in their order; each starts from the tables that are stored in the target folder.

    Returns the tables that the run has written.
    """
    wanted = list(stages)
    unknown = set(wanted) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages: {', '.join(sorted(unknown))}")
    if run.wide not in ("factors", "row", "loan", "none"):
        raise ValueError(f"unknown kind of wide table: {run.wide}")
    for name, stage in STAGES.items():
        if name in wanted:
            stage(run)
    return dict(run.written)


def run_pipeline(
    raw: DataFrame,
    target: str,
    params: ScoreParams = DEFAULT_PARAMS,
    ingest_at: datetime | None = None,
    wide: str = "factors",
) -> dict[str, DataFrame]:
    """From the raw loan frame to scores and marts; every table is written below ``target`` once.

    Returns the written tables. ``wide`` is ``factors`` (default), ``row`` for the joins' rows, which grow
    with the product of a member's rows, ``loan`` for one row per loan, or ``none``.
    """
    return run_stages(Run(raw.sparkSession, target, raw, params, ingest_at, wide))


# --- out of the folder -------------------------------------------------------------


def export_csv(tables: dict[str, DataFrame], target: str) -> None:
    """CSV copies of written tables, one folder each; tables with nested or binary columns have none."""
    for name, df in tables.items():
        if not any(t.startswith(("array", "struct", "binary")) for _, t in df.dtypes):
            write_csv(df, f"{target}/{name}")


def publish_tables(
    tables: dict[str, DataFrame],
    prefix: str = "",
    fmt: str | None = None,
    options: dict[str, str] | None = None,
) -> None:
    """Put written tables into the warehouse as ``<prefix><name>``, one after the other.

    In the session's own catalog ``loans`` becomes the partitioned and clustered table; with ``fmt``
    all tables go through that connector, with ``options``.
    """
    for name, df in tables.items():
        if name == "loans" and fmt is None:
            write_partitioned(df, f"{prefix}{name}", path=(options or {}).get("path"))
        else:
            write_table(df, f"{prefix}{name}", fmt, options)


def release_tables(
    spark: SparkSession, tables: Mapping[str, DataFrame], prefix: str = "", path: str | None = None
) -> Release:
    """Publish written tables together: all of them become readable by one switch.

    ``loans`` is partitioned by issue year besides. With the wide table's factors comes the view
    ``<prefix>unified`` that expands them.
    """
    release = Release(spark, prefix, path)
    for name, df in tables.items():
        if name == "loans":
            release.write(name, add_issue_year(df), partition_by=["issue_year"])
        else:
            release.write(name, df)
    release.switch()
    if "unified_factors" in tables:
        X.register_wide_view(spark, f"{prefix}unified_factors", f"{prefix}unified")
    return release
