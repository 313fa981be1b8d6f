"""Raw files against the layout that was stored for them: what moved, went, came or changed its type."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.schema import RAW_COLUMNS
from ledgerlark.sources.readers import read_raw_loans

LAYOUT = "file string, place int, name string, kind string"


@dataclass(frozen=True)
class Change:
    """One difference: ``missing``, ``added``, ``moved`` or ``type``; ``needed`` says if the engine uses it."""

    kind: str
    column: str
    detail: str
    needed: bool

    def __str__(self) -> str:
        return f"{self.kind} {self.column}: {self.detail}"


def header(spark: SparkSession, path: str) -> list[str]:
    """The column names of a CSV file or folder. Reads the first line only."""
    return spark.read.csv(path, header=True).columns


def layout_of(
    spark: SparkSession, path: str, kinds: Mapping[str, str] = RAW_COLUMNS, check_types: bool = True
) -> DataFrame:
    """``file, place, name, kind``: the columns of a raw file in their order.

    ``kind`` is the type a used column is read as if all its values are of that type, else ``string``;
    columns that are not used have none. Types are found in one pass that reads the used columns only.
    """
    names = header(spark, path)
    used = [n for n in names if n in kinds]
    bad: set[str] = set()
    if check_types and used:
        text = spark.read.csv(path, header=True)
        misfits = {
            n: F.count_if(F.col(n).isNotNull() & F.col(n).try_cast(kinds[n]).isNull())
            for n in used if kinds[n] != "string"
        }
        if misfits:
            found = text.agg(*(c.alias(n) for n, c in misfits.items())).first()
            bad = {n for n in misfits if found[n]}
    rows = [
        (path, i, n, None if n not in kinds else "string" if n in bad else kinds[n]) for i, n in enumerate(names)
    ]
    return spark.createDataFrame(rows, LAYOUT)


def changes(stored: DataFrame, found: DataFrame, kinds: Mapping[str, str] = RAW_COLUMNS) -> list[Change]:
    """Differences between two layouts, by column. A layout has a row per column, so it fits the driver."""
    before = {r.name: r for r in stored.collect()}
    now = {r.name: r for r in found.collect()}
    out = []
    for name in sorted(before.keys() | now.keys()):
        needed, old, new = name in kinds, before.get(name), now.get(name)
        if new is None:
            out.append(Change("missing", name, f"was column {old.place + 1}", needed))
        elif old is None:
            out.append(Change("added", name, f"is column {new.place + 1}", needed))
        else:
            if old.place != new.place:
                out.append(Change("moved", name, f"from column {old.place + 1} to {new.place + 1}", needed))
            if old.kind != new.kind and needed:
                out.append(Change("type", name, f"from {old.kind} to {new.kind}", needed))
    return out


def check_header(spark: SparkSession, path: str, kinds: Mapping[str, str] = RAW_COLUMNS) -> None:
    """Raise before a run when a used column is not in the file's header, or is in it twice."""
    names = [n.strip().lower() for n in header(spark, path)]
    missing = [n for n in kinds if n not in names]
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")


def checked_raw_loans(spark: SparkSession, path: str) -> DataFrame:
    """The used columns of a raw loan CSV whose header has been checked."""
    check_header(spark, path)
    return read_raw_loans(spark, path)


def write_layout(layout: DataFrame, path: str) -> None:
    layout.write.mode("overwrite").parquet(path)


def report(spark: SparkSession, path: str, stored_layout: str, kinds: Mapping[str, str] = RAW_COLUMNS) -> list[Change]:
    """Changes of a raw file against the layout stored in a folder."""
    return changes(spark.read.parquet(stored_layout), layout_of(spark, path, kinds), kinds)
