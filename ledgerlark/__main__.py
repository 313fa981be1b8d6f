"""Run the pipeline or some of its stages: ``spark-submit ... ledgerlark/__main__.py TARGET [--raw CSV]``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ledgerlark.functions.points import ScoreParams
from ledgerlark.plans.pipeline import STAGES, Run, export_csv, publish_tables, release_tables, run_stages
from ledgerlark.session import stored_bytes, tune
from ledgerlark.sources.drift import checked_raw_loans


def _option(text: str) -> tuple[str, str]:
    name, found, value = text.partition("=")
    if not found or not name:
        raise argparse.ArgumentTypeError(f"expected NAME=VALUE, got {text}")
    return name, value


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="ledgerlark", description="Loan file to loan scores.")
    parser.add_argument("target", help="folder of the result tables")
    parser.add_argument("--raw", help="raw loan CSV with a header, file or folder; for the stage clean")
    parser.add_argument(
        "--stage", action="append", choices=list(STAGES), dest="stages",
        help="run this stage from the tables in the folder; may be repeated; default: all of them",
    )
    parser.add_argument("--wide", choices=("factors", "row", "loan", "none"), default="factors",
                        help="kind of wide table")
    parser.add_argument("--csv", help="folder for CSV copies of the tables")
    parser.add_argument("--release", metavar="PREFIX", help="publish the written tables together as PREFIX<name>")
    parser.add_argument("--tables", metavar="PREFIX", help="write warehouse tables PREFIX<name> one by one")
    parser.add_argument("--format", help="connector for --tables; default is the session's catalog")
    parser.add_argument("--option", action="append", type=_option, default=[], metavar="NAME=VALUE",
                        help="option of the connector; may be repeated")
    given = parser.parse_args(arguments)
    stages = given.stages or list(STAGES)
    if "clean" in stages and given.raw is None:
        parser.error("the stage clean needs --raw")

    spark = SparkSession.builder.appName("ledgerlark").getOrCreate()
    raw = None
    if "clean" in stages:
        tune(spark, stored_bytes(spark, given.raw))
        raw = checked_raw_loans(spark, given.raw)
    else:
        tune(spark, stored_bytes(spark, given.target))
    run = Run(spark, given.target, raw, ScoreParams.from_conf(spark), wide=given.wide)
    written = run_stages(run, stages)
    if given.csv is not None:
        export_csv(written, given.csv)
    if given.tables is not None:
        publish_tables(written, given.tables, given.format, dict(given.option))
    if given.release is not None:
        release_tables(spark, written, given.release)


if __name__ == "__main__":
    main()
