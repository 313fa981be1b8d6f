"""Exact deduplication by content-defined chunk recipes, with DataFrame functions only.

A text without its white space is cut into chunks whose ends depend on the content: the first sentence
mark at least ``min_chars`` after the chunk's start, or ``max_chars`` when there is none. Each distinct
chunk gets an identifier: its 64-bit hash, plus a number that tells apart chunks of one hash. The
chunks' contents move once, merged before the shuffle, to find hashes with several contents; there are
normally none, and then no content moves again. A text's recipe is the list of its chunks' identifiers,
8 bytes for about 500 bytes of text; equal recipes are equal texts, whatever the texts' length.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerlark.sources.scratch import materialize

# The characters that equality ignores.
WHITE_SPACE = (" ", "\t", "\n", "\v", "\f", "\r")
MIN_CHARS = 384
MAX_CHARS = 4096
LARGEST = 9_223_372_036_854_775_807
# The distance of two ids has at most 20 digits.
SHIFT = Decimal(10**20)


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for character in WHITE_SPACE:
        out = F.replace(out, F.lit(character), F.lit(""))
    return out


def chunks_of(text: Column, min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS) -> Column:
    """The chunks of a text, in order; joined they are the text. None for an empty text."""
    pattern = f"(?s).{{{min_chars},{max_chars - 1}}}?[.!?]|.{{1,{max_chars}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def colliding(chunks: DataFrame) -> DataFrame:
    """``(h, chunk, nth)`` of the chunks whose hash ``h`` stands for several contents, numbered from 0."""
    distinct = chunks.groupBy("h", "chunk").agg(F.lit(1).alias("one"))
    several = distinct.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    nth = F.row_number().over(W.partitionBy("h").orderBy("chunk")) - 1
    return distinct.join(several, "h").select("h", "chunk", nth.cast("long").alias("nth"))


def _with_recipes(
    texts: DataFrame, min_chars: int, max_chars: int, hashed
) -> DataFrame:
    """``texts`` with a ``recipe``: for each chunk its hash, and its number where hashes collide."""
    cut = texts.withColumn("chunks", chunks_of(F.col("norm"), min_chars, max_chars))
    chunks = cut.select(F.explode("chunks").alias("chunk"))
    chunks = chunks.select(hashed(F.col("chunk")).alias("h"), "chunk")
    # One row for each chunk in a collision: empty but for about one in 10**9 chunks squared / 2**65.
    clashes = materialize(colliding(chunks), "colliding_chunks")
    recipe = F.transform("chunks", lambda c: hashed(c))
    if clashes.isEmpty():
        return cut.withColumn("recipe", recipe).drop("chunks", "norm")
    # Documents with such a chunk look up its number by content; positions keep the order.
    cut = cut.withColumn("row", F.monotonically_increasing_id())
    cut = materialize(cut, "cut_texts")
    at = cut.select("row", F.posexplode("chunks").alias("pos", "chunk"))
    at = at.join(clashes, "chunk").groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("pos", "nth"))).alias("numbers")
    )
    flat = F.flatten(F.transform("numbers", lambda x: F.array(x["pos"].cast("long"), x["nth"])))
    return (
        cut.withColumn("recipe", recipe)
        .join(at, "row", "left")
        .withColumn("recipe", F.concat("recipe", F.coalesce(flat, F.array().cast("array<bigint>"))))
        .drop("row", "chunks", "norm", "numbers")
    )


def _grouped(
    docs: DataFrame, id_col: str, text_col: str, min_chars: int, max_chars: int, hashed, *more: str
) -> DataFrame:
    """Each row of ``docs`` as ``id``, ``points``, ``sha`` and ``more``, with its group's ``group_size``
    and ``keep_id``."""
    id_, text = F.col(id_col), F.col(text_col)
    texts = docs.select(
        id_.cast("long").alias("id"),
        F.coalesce(F.length(text), F.lit(0)).alias("points"),
        normalised(text).alias("norm"),
        *more,
    ).withColumn("sha", F.sha2(F.col("norm").cast("binary"), 256))
    rows = _with_recipes(texts, min_chars, max_chars, hashed)
    # Most code points first, then the smallest id, as one number of fixed width: it can be
    # aggregated by hash, before the shuffle.
    best = F.col("points").cast("decimal(10,0)") * F.lit(SHIFT) + (
        F.lit(LARGEST).cast("decimal(20,0)") - F.coalesce("id", F.lit(LARGEST)).cast("decimal(20,0)")
    )
    groups = (
        rows.withColumn("best", best)
        .groupBy("recipe")
        .agg(F.max("best").alias("best"), F.count(F.lit(1)).alias("group_size"))
        .select(
            "recipe",
            "group_size",
            F.nullif(
                (F.lit(LARGEST).cast("decimal(20,0)") - F.col("best") % F.lit(SHIFT)).cast("long"),
                F.lit(LARGEST),
            ).alias("keep_id"),
        )
    )
    return rows.join(groups, "recipe")


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    max_chars: int = MAX_CHARS,
    hashed=F.xxhash64,
) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Of equal texts the one with the most code points before normalisation stays, then the smallest id.
    A null text counts as empty; empty texts are equal to each other. Rows that repeat an id are all
    listed; they are kept when their id is the kept one. A null id sorts after all others and is its
    own ``keep_id`` only in a group without any id. Other columns of ``docs`` are not looked at.
    """
    return _grouped(docs, id_col, text_col, min_chars, max_chars, hashed).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def kept_rows(
    docs: DataFrame,
    row_col: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    max_chars: int = MAX_CHARS,
    hashed=F.xxhash64,
) -> DataFrame:
    """The ``row_col`` of the one row that stays of each group of equal texts.

    As in ``exact_duplicates``, and of rows that repeat the kept id the one with the most code points
    and then the smallest ``row_col``, a long that no two rows share.
    """
    rows = _grouped(docs, id_col, text_col, min_chars, max_chars, hashed, row_col)
    # Often one row a group; the rows of a repeated id are merged before the shuffle.
    best = F.min(F.struct((-F.col("points")).alias("less"), F.col(row_col).alias("row"))).alias("best")
    rows = rows.where(F.col("id").eqNullSafe(F.col("keep_id"))).groupBy("recipe").agg(best)
    return rows.select(F.col("best.row").alias(row_col))
