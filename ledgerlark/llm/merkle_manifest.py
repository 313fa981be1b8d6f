"""A Merkle manifest of a table: one tree per group, one tree over the groups' roots.

Within a tree every ``fan`` consecutive nodes become their hash, level by level, until one is left. A
window over a chunk of ``fan ** depth`` consecutive leaves works out ``depth`` levels at once: a node of
level l stands on the row of its first leaf, so its siblings are lags and leads at fixed offsets of
multiples of ``fan ** l``, masked by its slot and by the length of its run, and the row of a run's first
node hashes the parent. Chunks are the leaves of the next round. A chunk has a bounded number of rows
whatever the group's size, so a group that holds most of the table is spread like any other.

Leaves are numbered through a range partitioning with a row number as the last key, which also splits
rows that are equal in everything else.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerlark.sources.scratch import materialize

FAN = 8
DEPTH = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEPS = "array<struct<before:string,after:string>>"
# The bits of a row number that count within a partition.
ROW_BITS = 33


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value as it enters a leaf: ``-`` for null, else its length in bytes, a colon and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _numbered(rows: DataFrame, order: Sequence[str], label: str) -> tuple[DataFrame, int]:
    """``rows`` with ``idx`` (0, 1, ... within ``key``, by ``order``) and ``total``, and the largest total.

    Rows are written in order by range partitions; a row's number within its partition and one count per
    (key, partition) give its place. Only the largest total comes to the driver.
    """
    ordered = rows.repartitionByRange("key", *order).sortWithinPartitions("key", *order)
    ordered = materialize(ordered.withColumn("row", F.monotonically_increasing_id()), label)
    ordered = ordered.withColumn("part", F.shiftright("row", ROW_BITS))
    whole = W.partitionBy("key")
    before = F.sum("n").over(whole.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    cells = (
        ordered.groupBy("key", "part")
        .agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
        .select(
            "key",
            "part",
            (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
            F.sum("n").over(whole).alias("total"),
        )
    )
    cells = materialize(cells, f"{label}_cells")
    most = cells.agg(F.max("total")).first()[0] or 0
    placed = ordered.join(cells, ["key", "part"]).withColumn("idx", F.col("row") + F.col("shift"))
    return placed.drop("row", "part", "shift"), most


def _round(nodes: DataFrame, fan: int, depth: int) -> DataFrame:
    """``nodes`` (key, idx, total, node, ...) with ``chunk``, ``steps`` and ``up``.

    ``steps`` are the siblings before and after each of a node's ancestors below the chunk's own node,
    from the bottom on; ``up``, on a chunk's first row, is the chunk's node.
    """
    idx = F.col("idx")
    within = W.partitionBy("key", "chunk").orderBy("idx")
    rows = nodes.withColumn("chunk", F.floor(idx / F.lit(fan**depth)).cast("long"))
    rows = rows.withColumn("up", F.col("node"))
    for level in range(depth):
        step = fan**level
        count = F.floor((F.col("total") + F.lit(step - 1)) / F.lit(step)).cast("long")
        nth = F.floor(idx / F.lit(step)).cast("long")
        slot = F.pmod(nth, F.lit(fan))
        run = F.least(F.lit(fan), count - nth + slot)
        is_node = (F.pmod(idx, F.lit(step)) == 0) & (count > 1)
        none = F.lit("")
        before = [
            F.when(slot >= k, F.lag("up", k * step).over(within)).otherwise(none)
            for k in range(fan - 1, 0, -1)
        ]
        after = [
            F.when(slot + k < run, F.lead("up", k * step).over(within)).otherwise(none)
            for k in range(1, fan)
        ]
        rows = rows.withColumns({"before": F.concat(*before), "after": F.concat(*after)})
        parent = F.when(count > 1, digest(F.col("up"), F.col("after"))).otherwise(F.col("up"))
        rows = rows.withColumns(
            {
                f"step{level}": F.when(is_node, F.struct("before", "after")),
                "up": F.when(F.pmod(idx, F.lit(step * fan)) == 0, parent),
            }
        ).drop("before", "after")
    # A node's siblings stand on its first leaf's row; the rows after it, up to the next node, take them.
    down = within.rowsBetween(W.unboundedPreceding, W.currentRow)
    names = [f"step{level}" for level in range(depth)]
    filled = rows.withColumns({n: F.last(n, ignorenulls=True).over(down) for n in names})
    return filled.withColumn("steps", F.array_compact(F.array(*names))).drop(*names)


def _climb(leaves: DataFrame, most: int, fan: int, depth: int, label: str) -> list[DataFrame]:
    """The leaves, the nodes ``depth`` levels above them, and so on up to one node per key; written."""
    tables = [leaves]
    while most > 1:
        size = fan**depth
        chunks = _round(tables[-1], fan, depth).where(F.pmod("idx", F.lit(size)) == 0)
        total = F.floor((F.col("total") + F.lit(size - 1)) / F.lit(size)).cast("long")
        chunks = chunks.select("key", F.col("chunk").alias("idx"), total.alias("total"), F.col("up").alias("node"))
        tables.append(materialize(chunks, f"{label}_level"))
        most = -(-most // size)
    return tables


def _descend(tables: list[DataFrame], top: DataFrame, fan: int, depth: int) -> DataFrame:
    """The leaves with all ``steps`` up to the top and the other columns of ``top`` (key, idx, steps, ...)."""
    for nodes in reversed(tables[:-1]):
        above = top.withColumnsRenamed({"idx": "chunk", "steps": "further"})
        rows = _round(nodes, fan, depth).drop("up")
        rows = rows.join(above, ["key", "chunk"]).drop("chunk")
        top = rows.withColumn("steps", F.concat("steps", "further")).drop("further")
        if nodes is not tables[0]:
            top = top.drop("node", "total")
    return top


def fold(node: Column, steps: Column) -> Column:
    """The root that ``node`` leads to with the siblings in ``steps``."""
    return F.aggregate(steps, node, lambda up, s: digest(s["before"], up, s["after"]))


def proof_digest(steps: Column) -> Column:
    """Digest of all siblings, level by level from the bottom, left to right."""
    return digest(F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), ""))


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    id_col: str = "doc_id",
    group_col: str = "lang",
    tampered: dict[str, Column] | None = None,
    fan: int = FAN,
    depth: int = DEPTH,
) -> DataFrame:
    """One row per row: id, ``leaf``, ``subroot``, ``root``, ``steps``, ``folded_root``, ``verified``.

    A leaf is the digest of ``fields`` in the order given. Leaves of a group ascend by id, null first, then
    by leaf; rows equal in both are interchangeable, as their digests are equal, and each keeps a place of
    its own. Groups ascend bytewise, the null group first; a group's only leaf is its subroot, the only
    subroot is the root. ``steps`` are the siblings from leaf to root. ``tampered`` gives changed
    values of some fields; the root is folded from the changed leaf and the original siblings. Empty and
    null texts differ (``0:`` and ``-``). An empty table gives no rows. Columns that are not fields, the
    id or the group are not looked at; their names may be any.
    """
    if fan < 2 or depth < 1:
        raise ValueError("a tree needs a fan of at least 2 and a depth of at least 1")
    changed = {name: (tampered or {}).get(name, F.col(name)) for name in fields}
    leaf = digest(*(field(F.col(name)) for name in fields))
    other = digest(*(field(changed[name]) for name in fields))
    differs = F.lit(False)
    for name in tampered or {}:
        differs = differs | ~changed[name].eqNullSafe(F.col(name))
    group = F.col(group_col).cast("string")
    leaves = docs.select(
        # Never null and ordered like the group.
        F.coalesce(F.concat(F.lit("1"), group), F.lit("0")).alias("key"),
        F.col(id_col).alias("id"),
        leaf.alias("node"),
        F.when(differs, other).alias("start"),
        F.monotonically_increasing_id().alias("nth"),
    )
    leaves, most = _numbered(materialize(leaves, "leaves"), ["id", "node", "nth"], "ordered_leaves")
    tables = _climb(leaves.drop("nth"), most, fan, depth, "leaf")

    subroots = tables[-1].select(F.lit("").alias("key"), F.col("key").alias("group"), "node")
    subroots, groups = _numbered(subroots, ["group"], "subroots")
    group_tables = _climb(subroots, groups, fan, depth, "subroot")
    none = F.lit(None).cast(STEPS)
    top = group_tables[-1].select("key", "idx", F.col("node").alias("root"))
    top = top.withColumn("steps", F.coalesce(none, F.array().cast(STEPS)))
    if len(group_tables) == 1:
        top = top.join(subroots.select("key", "idx", "group", "node"), ["key", "idx"])
    named = _descend(group_tables, top, fan, depth).select(
        F.col("group").alias("key"), F.lit(0).cast("long").alias("idx"), F.col("node").alias("subroot"),
        "root", "steps",
    )
    if len(tables) == 1:
        named = leaves.select("key", "idx", "id", "node", "start").join(named, ["key", "idx"])
    whole = _descend(tables, named, fan, depth)
    folded = fold(F.coalesce("start", "node"), F.col("steps"))
    return whole.select(
        F.col("id").alias(id_col), F.col("node").alias("leaf"), "subroot", "root", "steps",
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
