"""Near-duplicate groups by b-bit MinHash.

1. Tasks hash each text's shingles; a document becomes its set's size and digest, a hash per band of
   minima, and the low ``BITS`` bits of each minimum packed into a few longs. Equal sets are merged
   before the shuffle into one representative, the smallest id.
2. Every band bucket has a pivot, its smallest id. A representative is confirmed on full sets against
   the pivot with the best estimate only; this joins groups of copies of any size by one pair each.
3. Pairs of one bucket that are still in different components are then estimated. Those that may reach
   the threshold, also by the bound that a bitmap of each set gives, are confirmed as well. So no link
   between components is left out, and inside a component no pairs are made.

The estimate counts minima whose low bits agree, by ``bit_count`` over planes, and takes off the share
that agree in their low bits by chance. It is a filter with a margin of five standard deviations;
the full sets decide. A pair at the threshold shares no band with a probability of 5e-6. The bitmap has
a bit for each hash value of the set's members: a bit of one set that the other lacks is a member that the
other lacks, so the bound never refuses a pair that reaches the threshold.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.components import components
from ledgerlark.llm.membership import among, without
from ledgerlark.llm.shingles import SHINGLE, Signer, digest, shingle_set
from ledgerlark.sources.scratch import BATCH_ROWS, materialize

BANDS = 32
ROWS = 4
BITS = 4
PERCENT = 75
MAP_LONGS = 16
NO_ID = -(1 << 63)
HOT_SHARE = 1000


def least_matches(minima: int, bits: int, percent: int, deviations: float = 5.0) -> int:
    """The fewest agreeing minima of a pair that may reach the threshold.

    Low bits agree with probability ``j + (1 - j) / 2**bits`` at similarity ``j``.
    """
    j = percent / 100
    agree = j + (1 - j) / (1 << bits)
    return math.floor(minima * agree - deviations * math.sqrt(minima * agree * (1 - agree)))


def matches(a: list[Column], b: list[Column], minima: int, bits: int) -> Column:
    """How many minima agree, in all ``bits`` planes of low bits."""
    per = len(a) // bits
    xors = [x.bitwiseXOR(y) for x, y in zip(a, b, strict=True)]
    words = (reduce(Column.bitwiseOR, xors[i::per]) for i in range(per))
    differ = sum((F.bit_count(w) for w in words), F.lit(0))
    return F.lit(minima) - differ


def similarity(agreeing: Column, minima: int, bits: int) -> Column:
    """Estimated similarity, corrected for low bits that agree by chance."""
    chance = 1 / (1 << bits)
    return F.greatest(F.lit(0.0), (agreeing / F.lit(minima) - F.lit(chance)) / F.lit(1 - chance))


def spare(n: Column, longs: list[Column]) -> Column:
    """Members of a set beyond the bits of its bitmap."""
    return n - sum((F.bit_count(x) for x in longs), F.lit(0))


def may_reach(
    a: list[Column], b: list[Column], n_a: Column, n_b: Column, spare_a: Column, spare_b: Column, percent: int
) -> Column:
    """Whether sets of these bitmaps and sizes can be that similar; exact where it says no.

    Each bit that one set lacks is a member of the other that is not shared.
    """
    common = F.least(spare_a, spare_b) + sum(
        (F.bit_count(x.bitwiseAND(y)) for x, y in zip(a, b, strict=True)), F.lit(0)
    )
    return common * (100 + percent) >= (n_a + n_b) * percent


def bitmap(hashes: np.ndarray, longs: int = MAP_LONGS) -> np.ndarray:
    marks = np.zeros(longs * 64, dtype=bool)
    marks[(hashes >> np.uint64(32)) % np.uint64(longs * 64)] = True
    return np.packbits(marks).view(np.int64)


def _signed(batches, signer: Signer, size: int):
    longs = pa.list_(pa.int64())
    for batch in batches:
        ids, ns, marks, bands, packed, maps = [], [], [], [], [], []
        for key, text in zip(batch.column(0), batch.column(1), strict=True):
            hashes = shingle_set(bytes(text.as_buffer()) if text.is_valid else b"", size)
            ids.append(key.as_py())
            ns.append(len(hashes))
            if len(hashes):
                minima = signer.minima(hashes)
                marks.append(digest(hashes))
                bands.append(signer.bands_of(minima).view(np.int64))
                packed.append(signer.packed(minima).view(np.int64))
                maps.append(bitmap(hashes))
            else:
                marks.append(None)
                bands.append(None)
                packed.append(None)
                maps.append(None)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(marks, pa.binary()),
                pa.array(bands, longs), pa.array(packed, longs), pa.array(maps, longs),
            ],
            names=["id", "n", "mark", "bands", "packed", "map"],
        )


def _sets(batches, size: int):
    for batch in batches:
        for i in range(0, len(batch), 64):
            part = batch.slice(i, 64)
            sets = [
                shingle_set(bytes(t.as_buffer()) if t.is_valid else b"", size).view(np.int64)
                for t in part.column(1)
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["id", "hashes"]
            )


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``(u, v)`` whose full sets reach the threshold."""
    needed = pairs.select(F.col("u").alias("id")).union(pairs.select("v")).distinct()
    sets = among(texts, materialize(needed, "needed"), "id").mapInArrow(
        lambda it: _sets(it, size), "id long, hashes array<bigint>"
    )
    sets = materialize(sets, "shingle_sets", BATCH_ROWS)
    a = sets.select(F.col("id").alias("u"), F.col("hashes").alias("a"))
    b = sets.select(F.col("id").alias("v"), F.col("hashes").alias("b"))
    both = F.size(F.array_intersect("a", "b")).cast("long")
    either = F.size("a") + F.size("b") - both
    linked = pairs.join(a, "u").join(b, "v").where(both * 100 >= either * percent)
    return materialize(linked.select("u", "v").distinct(), "confirmed")


def _with_rep(rows: DataFrame, reps: DataFrame) -> DataFrame:
    """``rows`` with the ``rep`` of their ``mark``; a mark of many rows gets it without a shuffle.

    Fewer than ``HOT_SHARE`` marks can have more than that share of all rows, so the broadcast is bounded.
    """
    least = F.ceil(reps.agg(F.sum("copies").alias("n")).select(F.col("n") / F.lit(HOT_SHARE)).scalar())
    hot = reps.where((F.col("copies") > 1) & (F.col("copies") > least)).select("mark", F.col("rep").alias("hot_rep"))
    met = rows.join(F.broadcast(hot), "mark", "left")
    rest = met.where(F.col("hot_rep").isNull()).drop("hot_rep").join(reps.select("mark", "rep"), "mark")
    return met.where(F.col("hot_rep").isNotNull()).withColumnRenamed("hot_rep", "rep").unionByName(rest)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    bits: int = BITS,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id``, ``kept``.

    Documents are linked when 100 times their sets' intersection is at least ``percent`` times the
    union; a component's number is its smallest id. A null text or one without words has an empty set
    and is linked with nothing. Rows that repeat an id are one document and share a component, as their
    links do. Rows without an id count as one document that comes before all others. Other columns are
    not looked at.
    """
    signer, minima = Signer(bands, rows, bits), bands * rows
    texts = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
        F.col(text_col).cast("binary").alias("text"),
    )
    signed = texts.mapInArrow(
        lambda it: _signed(it, signer, size),
        "id long, n long, mark binary, bands array<bigint>, packed array<bigint>, map array<bigint>",
    )
    signed = materialize(signed.withColumn("row", F.monotonically_increasing_id()), "signatures", BATCH_ROWS)
    # Equal marks have equal bands, so one row speaks for them all.
    sets = signed.where("n > 0")
    reps = sets.groupBy("mark").agg(F.min(F.struct("id", "row")).alias("first"), F.count("*").alias("copies"))
    reps = materialize(reps.select("mark", "copies", F.col("first.id").alias("rep"), F.col("first.row").alias("row")), "reps")
    members = materialize(_with_rep(sets.select("id", "mark"), reps).select("id", "rep"), "members")
    names, maps_of = [f"s{i}" for i in range(-(-minima // 64) * bits)], [f"m{i}" for i in range(MAP_LONGS)]
    copies = materialize(sets.select("row").join(reps.select("row"), "row", "left_anti"), "copies")
    heads = without(sets, copies, "row").select(
        "id", "n", "bands", *(F.col("packed")[i].alias(c) for i, c in enumerate(names)),
        *(F.col("map")[i].alias(c) for i, c in enumerate(maps_of)),
    )
    heads = materialize(heads, "heads")
    # A band's number is part of its hash. Buckets of one document propose nothing.
    entries = heads.select("id", F.explode("bands").alias("h"))
    crowded = entries.groupBy("h").agg(F.min("id").alias("pivot"), F.max("id").alias("last"))
    crowded = crowded.where("pivot < last").select("h", "pivot")
    entries = materialize(entries.join(crowded, "h"), "bucket_entries")
    fewest = least_matches(minima, bits, percent)

    # Pairs are made of ids, and get their signatures once each; an id of several texts brings all of them.
    pairs = entries.where("id > pivot").select("id", "pivot").distinct()
    pivots = heads.select(F.col("id").alias("pivot"), *(F.col(c).alias(f"p_{c}") for c in names))
    proposed = pairs.join(heads.select("id", *names), "id").join(pivots, "pivot")
    agreeing = matches([F.col(c) for c in names], [F.col(f"p_{c}") for c in names], minima, bits)
    best = (
        proposed.withColumn("agree", agreeing)
        .where(F.col("agree") >= fewest)
        .groupBy("id")
        .agg(F.max(F.struct("agree", F.bitwise_not("pivot").alias("no"))).alias("best"))
        .select(F.col("id").alias("u"), F.bitwise_not("best.no").alias("v"))
    )
    best = materialize(best, "best_pivots")
    first = _confirmed(best, texts, size, percent)
    same_id = members.where("id > rep").select(F.col("id").alias("u"), F.col("rep").alias("v")).distinct()
    stars = components(first.unionByName(same_id))

    # What is still apart within a bucket.
    root = stars.select(F.col("u").alias("id"), F.col("v").alias("root"))
    placed = entries.select("id", "h").join(root, "id", "left").withColumn("root", F.coalesce("root", "id"))
    mixed = placed.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    mixed = mixed.where("lo < hi").select("h")
    apart = materialize(placed.join(mixed, "h", "left_semi"), "mixed_buckets")
    signs = among(heads.drop("bands"), materialize(apart.select("id").distinct(), "mixed_ids"), "id")
    apart = apart.join(signs, "id").withColumn("spare", spare(F.col("n"), [F.col(m) for m in maps_of]))
    apart = materialize(apart, "mapped_buckets")
    left = apart.select("h", *(F.col(n).alias(f"l_{n}") for n in ("id", "root", "n", "spare", *names, *maps_of)))
    agreeing = matches([F.col(n) for n in names], [F.col(f"l_{n}") for n in names], minima, bits)
    possible = may_reach(
        [F.col(n) for n in maps_of], [F.col(f"l_{n}") for n in maps_of], F.col("n"), F.col("l_n"),
        F.col("spare"), F.col("l_spare"), percent,
    )
    late = (
        left.join(apart, "h")
        .where((F.col("l_root") < F.col("root")) & (agreeing >= fewest) & possible)
        .select(F.greatest("id", "l_id").alias("u"), F.least("id", "l_id").alias("v"))
        .distinct()
    )
    late = materialize(late.join(best.select("u", "v"), ["u", "v"], "left_anti"), "late_pairs")
    if not late.isEmpty():
        second = _confirmed(late, texts, size, percent)
        stars = components(stars.unionByName(second))
    out = signed.select("id", "n").join(
        stars.select(F.col("u").alias("id"), F.col("v").alias("root")), "id", "left"
    )
    component = F.coalesce("root", "id")
    real = lambda c: F.nullif(c, F.lit(NO_ID))
    return out.select(
        real(F.col("id")).alias(id_col),
        F.col("n").alias("n_shingles"),
        real(component).alias("component_id"),
        (component == F.col("id")).alias("kept"),
    )


def kept_rows(
    docs: DataFrame, row_col: str, id_col: str = "doc_id", text_col: str = "text", **options: int
) -> DataFrame:
    """The ``row_col`` of the one row that stays of each component, when every row is a document.

    The smallest id stays, a missing one before all others, then the smallest ``row_col``, a long that no
    two rows share. ``options`` are those of ``near_duplicates``.
    """
    placed = near_duplicates(docs, row_col, text_col, **options).select(row_col, "component_id")
    ids = docs.select(row_col, F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"))
    # Merged before the shuffle, so a large component is no large group.
    best = F.min(F.struct("id", F.col(row_col).alias("row"))).alias("best")
    return placed.join(ids, row_col).groupBy("component_id").agg(best).select(F.col("best.row").alias(row_col))
