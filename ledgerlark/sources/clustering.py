"""One sort key over several columns, so that files can be skipped by a filter on any of them.

Each column becomes a code of a few bits that keeps its order, cut at quantiles of the data; the codes' bits
are interleaved. Rows that lie close together in the key are close in every column, so a file that holds a
range of keys has narrow minima and maxima in all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Bytes of a text that a code looks at; more would leave the range of a long.
PREFIX = 7
ACCURACY = 10_000


def _number(df: DataFrame, column: str) -> Column:
    """A number that keeps the column's order: a text's first bytes, or the value itself."""
    if df.schema[column].dataType == StringType():
        head = F.rpad(F.hex(F.substring(F.col(column).cast("binary"), 1, PREFIX)), 2 * PREFIX, "0")
        return F.conv(head, 16, 10).cast("long")
    return F.col(column).cast("double")


def interleaved_key(df: DataFrame, columns: Sequence[str], bits: int = 4) -> Column:
    """The interleaved key over ``columns``, ``bits`` bits of each; NULL counts as smallest.

    Runs one aggregation over these columns for ``2 ** bits - 1`` quantiles each, which is all that comes
    to the driver. Values that are frequent take a code of their own, by themselves or with neighbours.
    """
    steps = 1 << bits
    if bits * len(columns) > 62:
        raise ValueError("the key has at most 62 bits")
    shares = [i / steps for i in range(1, steps)]
    numbers = [_number(df, c) for c in columns]
    cuts = df.agg(
        *(F.percentile_approx(n, shares, ACCURACY).alias(f"c{i}") for i, n in enumerate(numbers))
    ).first()
    key = F.lit(0).cast("long")
    for i, number in enumerate(numbers):
        # Number of cuts at or below the value: grows with the value.
        code = F.lit(0).cast("long")
        for cut in cuts[i] or []:
            code = code + F.when(number >= F.lit(cut), 1).otherwise(0)
        for bit in range(bits):
            place = bit * len(columns) + len(columns) - 1 - i
            key = key.bitwiseOR(F.shiftleft(F.shiftright(code, bit).bitwiseAND(F.lit(1).cast("long")), place))
    return key
