"""Writing entity files, key lists and warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.cleaning import month_start
from ledgerlark.sources.clustering import interleaved_key

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV, one file per task."""
    df.write.mode("overwrite").csv(path, header=True)


def write_csv_single(df: DataFrame, path: str) -> None:
    """Header CSV in one file, whatever its size: one task streams all rows to it.

    For lists that a reader wants as one file; :func:`write_csv` writes any list in parallel. The work
    before the last step keeps its own partitions.
    """
    write_csv(df.repartition(1), path)


def write_table(
    df: DataFrame,
    name: str,
    fmt: str | None = None,
    options: dict[str, str] | None = None,
) -> None:
    """Replace a catalog table, or with ``fmt`` a table of a connector on the classpath.

    ``options`` go to the writer; ``path`` puts a catalog table into a folder of the caller's choice.
    """
    writer = df.write.mode("overwrite").options(**(options or {}))
    if fmt is None:
        writer.saveAsTable(name)
    else:
        writer.format(fmt).option("table", name).save()


def add_issue_year(loans: DataFrame) -> DataFrame:
    return loans.withColumn("issue_year", F.year(month_start(F.col("issue_date"))))


def write_partitioned(
    loans: DataFrame,
    name: str,
    path: str | None = None,
    years_only: bool = False,
) -> None:
    """Loans as a table partitioned by issue year, clustered by member and status over its files.

    Rows are dealt out by ranges of year and a key that interleaves member and status, so a file's minima
    and maxima prune by either; member and loan come last, so one hot member or busy year is split over
    several files. The whole table is replaced; with ``years_only`` an existing table only has the years present in
    ``loans`` replaced.
    """
    spark = loans.sparkSession
    key = interleaved_key(loans, ["member_id", "loan_status"])
    rows = (
        add_issue_year(loans.withColumn("_near", key))
        .repartitionByRange("issue_year", "_near", "member_id", "loan_id")
        .sortWithinPartitions("issue_year", "_near", "member_id", "loan_status")
        .drop("_near")
    )
    if years_only and spark.catalog.tableExists(name):
        # insertInto goes by position, and the partition column is last in both. It takes the
        # overwrite mode from the session only.
        before = spark.conf.get(OVERWRITE_MODE, None)
        spark.conf.set(OVERWRITE_MODE, "dynamic")
        try:
            rows.write.insertInto(name, overwrite=True)
        finally:
            if before is None:
                spark.conf.unset(OVERWRITE_MODE)
            else:
                spark.conf.set(OVERWRITE_MODE, before)
        return
    writer = rows.write.mode("overwrite").partitionBy("issue_year")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
