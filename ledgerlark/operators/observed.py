"""Profiles that are counted while rows are written, by observed metrics instead of scans of their own.

Counts before cleaning ride on the write of the keyed raw rows, counts after it on the write of each clean
table. All of them are counted in the tasks that write, whose results count once however often a task
is repeated.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlark import schema as S
from ledgerlark.operators import identity as I
from ledgerlark.operators import quality as Q

ENTITIES = {
    "customers": (S.CUSTOMERS_SOURCE, S.CUSTOMERS_DDL),
    "loans": (S.LOANS_SOURCE, S.LOANS_DDL),
    "repayments": (S.REPAYMENTS_SOURCE, S.REPAYMENTS_DDL),
    "defaulters": (S.DEFAULTERS_SOURCE, S.DEFAULTERS_DDL),
}
PROFILE = "table_name string, step string, metric string, n long"


class Profile:
    """Observations by (table, step); read them once the frames they ride on are written."""

    def __init__(self):
        self._seen: dict[tuple[str, str], Observation] = {}

    def ride(self, df: DataFrame, table: str, step: str, metrics: Mapping[str, Column]) -> DataFrame:
        """``df``, with ``metrics`` counted when it runs."""
        # Named per call, so that two profiles in one session do not meet.
        observation = self._seen[table, step] = Observation()
        named = [value.cast("long").alias(name) for name, value in metrics.items()]
        return df.observe(observation, *named)

    def rows(self, spark: SparkSession) -> DataFrame:
        """``table_name, step, metric, n``: as many rows as there are metrics, whatever the tables' size."""
        found = [
            (table, step, metric, n)
            for (table, step), observation in self._seen.items()
            for metric, n in observation.get.items()
        ]
        return spark.createDataFrame(found, PROFILE)


def _nulls(columns: Mapping[str, Column]) -> dict[str, Column]:
    return {f"null {name}": F.count_if(value.isNull()) for name, value in columns.items()}


def null_metrics(df: DataFrame) -> dict[str, Column]:
    """Rows, and NULLs per column."""
    return {"rows": F.count(F.lit(1)), **_nulls({c: F.col(c) for c in df.columns})}


def ride_raw(profile: Profile, keyed: DataFrame) -> DataFrame:
    """Rows and NULLs of each entity before cleaning, and the repayment rules, over the keyed raw rows."""
    for name, (source, layout) in ENTITIES.items():
        columns = I.conformed(I.entity_columns(source), layout)
        names = [part.strip().split(" ")[0] for part in layout.split(",")]
        values = dict(zip(names, columns, strict=True))
        metrics = {"rows": F.count(F.lit(1)), **_nulls(values)}
        if name == "repayments":
            complete = F.lit(True)
            for required in S.REPAYMENT_REQUIRED:
                complete = complete & values[required].isNotNull()
            rules = Q.repayment_rules(values)
            metrics |= {f"rule {rule}": F.count_if(complete & hit) for rule, hit in rules.items()}
        keyed = profile.ride(keyed, name, "raw", metrics)
    return keyed


def ride_distinct_customers(profile: Profile, customers: DataFrame) -> DataFrame:
    """The customer rules over renamed, distinct rows."""
    metrics = {f"rule {rule}": F.count_if(hit) for rule, hit in Q.customer_rules().items()}
    return profile.ride(customers, "customers", "distinct", metrics)


def ride_clean(profile: Profile, name: str, df: DataFrame) -> DataFrame:
    """Rows and NULLs of a clean table."""
    return profile.ride(df, name, "clean", null_metrics(df.drop("ingest_date")))
