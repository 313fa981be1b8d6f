"""Compare every registered query with its SQL: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import oracle_sql
from checks.registry import QUERIES

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


KINDS = {"double": "DOUBLE", "bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN"}


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(float(r[i]) if isinstance(r[i], Decimal) else r[i] for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is not None, v) for v in r))


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both give the same columns, types and rows; otherwise what differs."""
    expected = con.sql(sql)
    types = dict(zip(expected.columns, map(str, expected.types), strict=True))
    ours = {n: KINDS.get(t, t) for n, t in df.dtypes}
    if ours != types:
        return f"columns {sorted(ours.items() ^ types.items())}"
    left = _sorted_rows(df.columns, df.collect())
    right = _sorted_rows(expected.columns, expected.fetchall())
    if len(left) != len(right):
        return f"{len(left)} rows, expected {len(right)}"
    for a, b in zip(left, right, strict=True):
        if a != b:
            return f"row {a}, expected {b}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    spark, con, sql = session(), duck(sf_dir), oracle_sql()
    failed = 0
    for name in names or QUERIES:
        start = time.perf_counter()
        try:
            problem = difference(QUERIES[name](spark, sf_dir), con, sql[name])
        except Exception as error:  # noqa: BLE001  report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        verdict = "ok " if problem is None else "BAD"
        print(f"{verdict} {name} {time.perf_counter() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} of {len(names or QUERIES)} differ; without SQL: {sorted(set(QUERIES) - set(sql))}")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
