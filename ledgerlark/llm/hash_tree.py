"""Sharding by a weighted hash tree: region, rack, shard, with DataFrame functions only.

At each level a row draws a number for each child from a hash of its id and the child's name, and goes
down to the child whose exponential ``-ln(u) / weight`` is the smallest; a child wins in proportion to
its weight. A child's draw depends on its own name and weight alone, so a changed weight moves rows
into or out of that child's subtree and nowhere else.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.numbering import number_within, parts_for

FIXED_BYTES = 16


@dataclass(frozen=True)
class Shard:
    number: int
    weight: float = 1.0


@dataclass(frozen=True)
class Rack:
    name: str
    shards: tuple[Shard, ...]

    @property
    def weight(self) -> float:
        return sum(s.weight for s in self.shards)


@dataclass(frozen=True)
class Region:
    name: str
    racks: tuple[Rack, ...]

    @property
    def weight(self) -> float:
        return sum(r.weight for r in self.racks)


Tree = tuple[Region, ...]


def regular_tree(shards: int, per_rack: int = 4, racks_per_region: int = 2) -> Tree:
    """``shards`` shards of weight 1, filled up rack by rack and region by region."""
    if min(shards, per_rack, racks_per_region) < 1:
        raise ValueError("a tree needs at least one shard, rack and region")
    numbers = [Shard(i) for i in range(shards)]
    racks = [
        Rack(f"rack{i // per_rack}", tuple(numbers[i : i + per_rack]))
        for i in range(0, shards, per_rack)
    ]
    return tuple(
        Region(f"region{i // racks_per_region}", tuple(racks[i : i + racks_per_region]))
        for i in range(0, len(racks), racks_per_region)
    )


def with_one_more(tree: Tree) -> Tree:
    """The tree with one more shard of weight 1, in a rack and region of its own.

    No weight in the old regions changes, so the only moves are into the new shard.
    """
    number = 1 + max(s.number for region in tree for rack in region.racks for s in rack.shards)
    return (*tree, Region(f"added{number}", (Rack(f"added{number}", (Shard(number),)),)))


def _smallest(key: Column, children: list[tuple[str, float]]) -> Column:
    """Position of the child that wins the draw; a child of weight 0 never wins beside others."""
    draws = []
    for i, (name, weight) in enumerate(children):
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(name), key), 11)
        u = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
        cost = -F.log(u) / F.lit(float(weight)) if weight > 0 else F.lit(float("inf"))
        draws.append(F.struct(cost.alias("cost"), F.lit(i).alias("child")))
    return draws[0]["child"] if len(draws) == 1 else F.array_min(F.array(*draws))["child"]


def _choose(position: Column, options: list[Column]) -> Column:
    """``options[position]``, of which only that one is worked out."""
    out = options[-1]
    for i in reversed(range(len(options) - 1)):
        out = F.when(position == i, options[i]).otherwise(out)
    return out


def place(df: DataFrame, key: str, tree: Tree, name: str) -> DataFrame:
    """Add the shard of each row as ``name``; the columns of the levels above are dropped again.

    The only inputs are the key and the tree. A null key is a key like any other.
    """
    id_ = F.col(key)
    df = df.withColumn("_region", _smallest(id_, [(r.name, r.weight) for r in tree]))
    racks = [_smallest(id_, [(f"{g.name}/{k.name}", k.weight) for k in g.racks]) for g in tree]
    df = df.withColumn("_rack", _choose(F.col("_region"), racks))

    def shard(region: Region, rack: Rack) -> Column:
        path = f"{region.name}/{rack.name}"
        won = _smallest(id_, [(f"{path}/{s.number}", s.weight) for s in rack.shards])
        return _choose(won, [F.lit(s.number) for s in rack.shards])

    shards = [_choose(F.col("_rack"), [shard(g, k) for k in g.racks]) for g in tree]
    df = df.withColumn(name, _choose(F.col("_region"), shards).cast("int"))
    return df.drop("_region", "_rack")


def shard_rows(
    docs: DataFrame, tree: Tree, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``,
    ``grown_shard``.

    The law is ``key``: the id and the tree decide. ``size`` is the text's UTF-8 bytes plus 16, a null
    text has none; its checksum is that of no bytes. ``slot`` numbers a shard's rows without a gap by
    a fixed order of ids; rows that repeat an id share a shard and get a slot each. ``grown_shard`` is
    the shard after one more has been added.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        (F.octet_length(text) + F.lit(FIXED_BYTES)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    rows = place(rows, "id", tree, "shard")
    parts = parts_for(docs.count())
    rows = number_within(rows, ["shard"], ["id", "text_crc32", "size"], "slot", parts)
    rows = place(rows, "id", with_one_more(tree), "grown_shard")
    return rows.select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )
