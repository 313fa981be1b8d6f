"""Reading raw files, entity files and warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.schema import RAW_COLUMNS

CORRUPT_COLUMN = "_corrupt_record"


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with inferred types. Costs one extra pass over the file: for probes only."""
    return spark.read.csv(path, header=True, inferSchema=True)


def read_csv_positional(
    spark: SparkSession, path: str, ddl: str, keep_corrupt: bool = False
) -> DataFrame:
    """Header CSV whose columns take name and type from ``ddl`` by position.

    A value that does not fit its type becomes NULL. With ``keep_corrupt`` the text of such a row
    is kept in a last column ``_corrupt_record``.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        ddl = f"{ddl}, {CORRUPT_COLUMN} string"
    return reader.schema(ddl).csv(path)


def read_raw_loans(spark: SparkSession, path: str) -> DataFrame:
    """The used columns of the raw loan CSV, by header name and with fixed types.

    Only the header line is read to find the columns, so there is no inference pass; numbers are
    cast from text, and the parser skips the columns that are not used.
    """
    text = spark.read.csv(path, header=True)
    return text.select(
        *(
            F.col(name) if kind == "string" else F.col(name).try_cast(kind).alias(name)
            for name, kind in RAW_COLUMNS.items()
        )
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def widen(df: DataFrame) -> DataFrame:
    """Store types of the warehouse: float as double, int as bigint."""
    wide = {"float": "double", "int": "bigint"}
    return df.select(
        *(F.col(n).cast(wide[t]).alias(n) if t in wide else F.col(n) for n, t in df.dtypes)
    )


def read_table(
    spark: SparkSession, name: str, fmt: str | None = None, options: dict[str, str] | None = None
) -> DataFrame:
    """A catalog table, or with ``fmt`` a table of a connector on the classpath."""
    if fmt is None:
        table = spark.table(name)
    else:
        table = spark.read.format(fmt).options(**(options or {})).option("table", name).load()
    return widen(table)
