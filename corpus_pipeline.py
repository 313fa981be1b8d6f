"""A corpus from raw documents to packed sequences, one stage after the other.

All stages but the last return the columns of ``documents``. Rows are decided each for itself, also those
that repeat an id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import bbit_minhash, chunk_recipes, ppm_language, slack_packing, suffix_dedup
from ledgerlark.llm.membership import without
from ledgerlark.llm.queries import WORD_TOKENIZER
from ledgerlark.sources.scratch import BATCH_ROWS, materialize, numbered


def _free(docs: DataFrame, name: str) -> str:
    """``name``, or one like it that no column of ``docs`` has."""
    while name in docs.columns:
        name += "_"
    return name


def _kept(docs: DataFrame, choose: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The rows of ``docs`` that ``choose`` keeps, told apart by a number."""
    row = _free(docs, "row")
    rows = numbered(docs, row)
    plain = rows.select("doc_id", "text", F.col(row).alias("row"))
    kept = choose(plain, "row").select(F.col("row").alias(row))
    dropped = materialize(rows.select(row).join(kept, row, "left_anti"), "dropped")
    return without(rows, dropped, row).select(docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have no language go: null texts and texts without a letter, and only these.

    A null ``lang`` becomes the predicted language. Rows are decided each for itself; only those without a
    ``lang`` are shuffled, and of the others no text is stored.
    """
    row, told = _free(docs, "row"), _free(docs, "told")
    rows = numbered(docs, row)
    plain = rows.select("doc_id", "text", "lang", F.col(row).alias("row"))
    languages = materialize(ppm_language.languages(plain, "row"), "languages", BATCH_ROWS)
    silent = languages.where(~F.col("letter")).select(F.col("row").alias(row))
    named = without(rows.where(F.col("lang").isNotNull()), silent, row).select(docs.columns)
    found = languages.where("letter").select(F.col("row").alias(row), F.col("language").alias(told))
    filled = rows.where(F.col("lang").isNull()).join(found, row).withColumn("lang", F.col(told))
    return named.unionByName(filled.select(docs.columns))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal but for white space, one row stays.

    Null counts as empty text; rows that repeat an id are rows of their own.
    """
    return _kept(docs, chunk_recipes.kept_rows)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, one row stays, of the smallest id.

    Null and empty texts are alike to none; rows that repeat an id are rows of their own.
    """
    return _kept(docs, bbit_minhash.kept_rows)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes that stand earlier in the corpus go; a document without text left goes too.

    ``n_chars`` follows the text. Other columns are carried along under names of their own; of rows that
    are equal in id and text the operator keeps the first.
    """
    others = {c: f"_c{i}" for i, c in enumerate(c for c in docs.columns if c not in ("doc_id", "text"))}
    renamed = docs.select("doc_id", "text", *(F.col(c).alias(n) for c, n in others.items()))
    cut = suffix_dedup.remove_repeats(renamed, carry=list(others.values()), whole_characters=True)
    text = F.col("kept").cast("string")
    cut = cut.where((F.col("n_removed") == 0) | (F.trim(text) != ""))
    if "n_chars" in others:
        cut = cut.withColumn(others["n_chars"], F.length(text).cast(docs.schema["n_chars"].dataType))
    back = {**{c: F.col(n) for c, n in others.items()}, "doc_id": F.col("doc_id"), "text": text}
    return cut.select(*(back[c].alias(c) for c in docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as pieces in sequences of 2048 ids."""
    return slack_packing.pack(docs, WORD_TOKENIZER)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("repeats", repeats),
    ("packing", packing),
]

# Code lengths, windows over bytes and packing have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
