"""Member key and the split of the raw loan file into four entities."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ledgerlark import schema as S


def member_identity(
    raw: DataFrame,
    columns: Iterable[str] = S.IDENTITY_COLUMNS,
    alias: str = "name_sha2",
    strict: bool = False,
) -> DataFrame:
    """Add the SHA-256 of the identity columns' joined text.

    NULLs are skipped in the text, so rows that differ only in which column is NULL share a key.
    ``strict`` writes a marker for NULL instead and keeps them apart.
    """
    parts = [F.col(c).cast("string") for c in columns]
    if strict:
        parts = [F.coalesce(p, F.lit("\u0000")) for p in parts]
    return raw.withColumn(alias, F.sha2(F.concat_ws(S.IDENTITY_SEPARATOR, *parts), 256))


def entity_columns(columns: Iterable[str]) -> list[Column]:
    """The columns of an entity, from the raw frame with its member key."""
    derived = {
        "member_id": F.col("name_sha2").alias("member_id"),
        "loan_id": F.col("id").alias("loan_id"),
        "country": F.lit("USA").alias("country"),
    }
    return [derived.get(c, F.col(c)) for c in columns]


def _entity(raw_with_key: DataFrame, columns: Iterable[str]) -> DataFrame:
    return raw_with_key.select(*entity_columns(columns))


def split_customers(raw_with_key: DataFrame) -> DataFrame:
    return _entity(raw_with_key, S.CUSTOMERS_SOURCE)


def split_loans(raw_with_key: DataFrame) -> DataFrame:
    return _entity(raw_with_key, S.LOANS_SOURCE)


def split_repayments(raw_with_key: DataFrame) -> DataFrame:
    return _entity(raw_with_key, S.REPAYMENTS_SOURCE)


def split_defaulters(raw_with_key: DataFrame) -> DataFrame:
    return _entity(raw_with_key, S.DEFAULTERS_SOURCE)


def conformed(columns: Sequence[Column], layout: str | StructType) -> list[Column]:
    """``columns`` with the names and types of ``layout`` by position, as a trip through CSV would.

    Text loses outer blanks, empty text becomes NULL, a number that does not fit becomes NULL.
    """
    target = StructType.fromDDL(layout) if isinstance(layout, str) else layout
    if len(target) != len(columns):
        raise ValueError(f"expected {len(target)} columns, got {len(columns)}")
    picked = []
    for source, field in zip(columns, target, strict=True):
        if field.dataType == StringType():
            value = F.nullif(F.trim(source.cast("string")), F.lit(""))
        else:
            value = source.try_cast(field.dataType)
        picked.append(value.alias(field.name))
    return picked


def conform(df: DataFrame, layout: str | StructType) -> DataFrame:
    """Give an entity the names and types of ``layout``, see :func:`conformed`."""
    return df.select(*conformed([F.col(c) for c in df.columns], layout))


def customers_entity(raw_with_key: DataFrame) -> DataFrame:
    return conform(split_customers(raw_with_key), S.CUSTOMERS_DDL)


def loans_entity(raw_with_key: DataFrame) -> DataFrame:
    return conform(split_loans(raw_with_key), S.LOANS_DDL)


def repayments_entity(raw_with_key: DataFrame) -> DataFrame:
    return conform(split_repayments(raw_with_key), S.REPAYMENTS_DDL)


def defaulters_entity(raw_with_key: DataFrame) -> DataFrame:
    return conform(split_defaulters(raw_with_key), S.DEFAULTERS_DDL)


def all_entities(raw_with_key: DataFrame) -> DataFrame:
    """The conformed columns of the four entities side by side, one row per raw row."""
    layouts = (
        (S.LOANS_SOURCE, S.LOANS_DDL),
        (S.REPAYMENTS_SOURCE, S.REPAYMENTS_DDL),
        (S.CUSTOMERS_SOURCE, S.CUSTOMERS_DDL),
        (S.DEFAULTERS_SOURCE, S.DEFAULTERS_DDL),
    )
    fields = {}
    for columns, ddl in layouts:
        for column, field in zip(columns, StructType.fromDDL(ddl), strict=True):
            fields.setdefault(column, field)
    return conform(_entity(raw_with_key, fields), StructType(list(fields.values())))
