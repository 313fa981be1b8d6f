"""Keys in less room, for shuffles that send one row per key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def packed(key: Column) -> Column:
    """A text key as bytes, one to one: two digits a byte where it is lower-case hex, as a member id is."""
    half = F.unhex(key)
    plain = F.concat(F.lit(b"\x00"), key.cast("binary"))
    return F.when(F.lower(F.hex(half)) == key, F.concat(F.lit(b"\x01"), half)).otherwise(plain)


def unpacked(value: Column) -> Column:
    """The text of :func:`packed`."""
    rest = F.substring(value, 2, 2**31 - 1)
    return F.when(F.substring(value, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))
