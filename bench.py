"""Time the headline queries: ``BENCH_SF_DIR`` (input folder), ``BENCH_CPUS`` (cores), ``BENCH_RUNS``.

Each query is run to its last row without a result being collected: one warm-up run, then the median
of ``BENCH_RUNS`` runs. ``write_tables`` is the one-off write of the clean tables that the warehouse
queries read; it is timed on its own. Prints one JSON line; ``value`` is the sum of all medians.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import QUERIES, raw_loans
from ledgerlark.operators import identity as I
from ledgerlark.operators import quality as Q
from ledgerlark.plans.pipeline import write_tables
from ledgerlark.sources.scratch import scratch_path

HEADLINE = (
    "member_identity",
    "split_customers",
    "clean_customers",
    "clean_loans",
    "clean_repayments",
    "clean_delinquency",
    "clean_records_detail",
    "profile_rules",
    "bad_members",
    "customers_new",
    "anti_join_bad",
    "score_payment_history",
    "score_financial_health",
    "score_pipeline",
    "score_single_pass",
    "star_schema",
    "mart_grade_share",
    "mart_default_rate_state",
    "unified_table",
    "unified_table_loan_grain",
)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action, runs: int) -> float:
    action()
    seconds = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def store_tables(spark: SparkSession, sf_dir: str) -> None:
    base = scratch_path(spark, "bench")
    write_tables(raw_loans(spark, sf_dir), lambda name: f"{base}/{name}")


def probe_one_by_one(spark: SparkSession, sf_dir: str) -> None:
    """For comparison with ``profile_rules``: one job per probe, as six separate counts."""
    repayments = I.repayments_entity(I.member_identity(raw_loans(spark, sf_dir)))
    for rule in Q.repayment_rules().values():
        run(repayments.where(rule).agg(F.count(F.lit(1)).alias("n")))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerlark-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {"write_tables": timed(lambda: store_tables(spark, sf_dir), runs)}
    for name in HEADLINE:
        seconds[name] = timed(lambda query=QUERIES[name]: run(query(spark, sf_dir)), runs)
    seconds["profile_one_job_per_rule"] = timed(lambda: probe_one_by_one(spark, sf_dir), runs)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
