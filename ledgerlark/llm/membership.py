"""Rows whose key is, or is not, in a list of any size; wide rows that a bitmap decides are not shuffled.

A bitmap of the listed keys' hashes, ``BITS_A_KEY`` bits a key and ``MOST_BITS`` in all, is broadcast in
words of 64 bits. It only says no for sure: rows that it lets through meet the list itself in a join, so
the results are those of ``left_semi`` and ``left_anti`` joins for a list of any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS_A_KEY = 16
MOST_BITS = 1 << 24


def _met(rows: DataFrame, keys: DataFrame, key: str, most_bits: int) -> tuple[DataFrame, str]:
    """``rows`` with a column that is 0 where ``key`` is surely not among ``keys``; its name."""
    names = {c.lower() for c in rows.columns}
    word, bits = "_word", "_bits"
    while {word, bits} & names:
        word, bits = word + "_", bits + "_"
    size = min(most_bits, BITS_A_KEY * max(64, keys.count()))
    place = F.pmod(F.xxhash64(key), F.lit(size))
    here, bit = F.shiftright(place, 6), F.pmod(place, F.lit(64)).cast("int")
    words = keys.select(here.alias(word), F.lit(1).cast("long").alias("one"), bit.alias("bit"))
    words = words.groupBy(word).agg(F.bit_or(F.expr("shiftleft(one, bit)")).alias(bits))
    met = rows.withColumn(word, here).join(F.broadcast(words), word, "left")
    return met.withColumn(bits, F.coalesce(F.getbit(bits, bit), F.lit(0))).drop(word), bits


def among(rows: DataFrame, keys: DataFrame, key: str, most_bits: int = MOST_BITS) -> DataFrame:
    """The rows whose ``key`` is in ``keys``, a stored table with that one column without nulls."""
    met, bit = _met(rows, keys, key, most_bits)
    return met.where(F.col(bit) == 1).join(keys, key, "left_semi").select(rows.columns)


def without(rows: DataFrame, keys: DataFrame, key: str, most_bits: int = MOST_BITS) -> DataFrame:
    """The rows whose ``key`` is not in ``keys``, a stored table with that one column without nulls."""
    met, bit = _met(rows, keys, key, most_bits)
    rest = met.where(F.col(bit) == 1).join(keys, key, "left_anti")
    return met.where(F.col(bit) == 0).select(rows.columns).unionByName(rest.select(rows.columns))
