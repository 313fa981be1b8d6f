"""Hard negatives of a vector table: exact scores by Strassen multiplication of integer tiles.

Rows are packed into tiles of a bounded number of rows. Every anchor tile meets every candidate tile in
one cell of a grid, a cell being one row of an equi-join on the two tiles' numbers. A cell's scores are
one matrix product, worked out by Strassen's seven products of halves. Its best rows per anchor are a
small heap; heaps of different cells merge by a window that keeps the first rows before and after its
shuffle. The first pass finds the positives, the second one the negatives within each positive's window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlark.sources.scratch import materialize

SCALE = 256
LEAF = 32
# Largest size of a float up to which all whole numbers are exact.
EXACT = 1 << 53
TILE = "n long, nth array<long>, ids binary, labels binary, width int, kind string, cells binary, given binary"
HEAP = "anchor long, place int, score long, nth long, id long"


# --- products ----------------------------------------------------------------


def _largest(a: np.ndarray) -> int:
    return max(int(a.max()), -int(a.min())) if a.size else 0


def _direct(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact product; in floats where no sum can leave their whole numbers."""
    if a.shape[1] * _largest(a) * _largest(b) < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def _padded(a: np.ndarray) -> np.ndarray:
    rows, columns = a.shape
    return np.pad(a, ((0, rows & 1), (0, columns & 1))) if rows & 1 or columns & 1 else a


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of int64 matrices. Odd sides are padded with zeros.

    Sums and products wrap modulo 2**64, so the result is right wherever it fits 64 bits, whatever the
    intermediate sums are.
    """
    rows, columns = a.shape[0], b.shape[1]
    if min(rows, a.shape[1], columns) <= leaf:
        return _direct(a, b)
    a, b = _padded(a), _padded(b)
    i, k, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :k], a[:i, k:], a[i:, :k], a[i:, k:]
    b11, b12, b21, b22 = b[:k, :j], b[:k, j:], b[k:, :j], b[k:, j:]
    both = strassen(a11 + a22, b11 + b22, leaf)
    low = strassen(a21 + a22, b11, leaf)
    right = strassen(a11, b12 - b22, leaf)
    left = strassen(a22, b21 - b11, leaf)
    high = strassen(a11 + a12, b22, leaf)
    out = np.empty((2 * i, 2 * j), dtype=np.int64)
    out[:i, :j] = both + left - high + strassen(a12 - a22, b21 + b22, leaf)
    out[:i, j:] = right + high
    out[i:, :j] = low + left
    out[i:, j:] = both - low + right + strassen(a21 - a11, b11 + b12, leaf)
    return out[:rows, :columns]


# --- tiles -------------------------------------------------------------------


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix, shorter ones filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), int(lengths.max()) if len(lengths) else 0), dtype=np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = values
    return out


def _narrow(a: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest type that holds them."""
    size = _largest(a)
    return a.astype(next(t for t in ("<i1", "<i2", "<i4", "<i8") if size <= np.iinfo(t).max or t == "<i8"))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One tile of all rows of a partition, in the order of their ids, null last."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    table = pa.Table.from_batches(parts)
    order = np.lexsort((table["nth"].to_numpy(), table["id"].fill_null(np.iinfo(np.int64).max).to_numpy()))
    table = table.take(pa.array(order)).combine_chunks()
    cells = _narrow(_matrix(table["vector"].chunk(0)))
    ids = table["id"].fill_null(np.iinfo(np.int64).max).to_numpy().astype("<i8")
    given = table["id"].is_valid().to_numpy(zero_copy_only=False).astype("u1")
    row = {
        "n": len(ids),
        "nth": table["nth"].to_numpy(),
        "ids": ids.tobytes(),
        "labels": table["label"].to_numpy().astype("<i8").tobytes(),
        "width": cells.shape[1],
        "kind": cells.dtype.str,
        "cells": cells.tobytes(),
        "given": given.tobytes(),
    }
    types = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 2, pa.int32(), pa.string(), pa.binary(), pa.binary()]
    yield pa.RecordBatch.from_arrays(
        [pa.array([v], t) for v, t in zip(row.values(), types, strict=True)], names=list(row)
    )


def _tiles(rows: DataFrame, count: int, per_tile: int, name: str) -> tuple[DataFrame, int]:
    """``rows`` as tiles numbered ``name``, dealt out evenly; and how many numbers there are."""
    dealt = rows.repartition(max(1, -(-count // per_tile)))
    tiles = materialize(dealt.mapInArrow(_packed, TILE).withColumn(name, F.spark_partition_id()), name)
    return tiles, (tiles.agg(F.max(name)).first()[0] or 0) + 1


class _Tile:
    """One tile of a batch row; columns carry ``suffix``."""

    def __init__(self, batch: pa.RecordBatch, at: int, suffix: str):
        def of(name):
            return batch.column(batch.schema.get_field_index(f"{name}{suffix}"))[at].as_py()

        self.nth = np.array(of("nth"), dtype=np.int64)
        self.ids, self.labels = (np.frombuffer(of(n), "<i8") for n in ("ids", "labels"))
        self.given = np.frombuffer(of("given"), "u1")
        flat = np.frombuffer(of("cells"), of("kind")).astype(np.int64)
        self.matrix = flat.reshape(of("n"), of("width"))


def _scores(anchors: _Tile, others: _Tile) -> np.ndarray:
    width = max(anchors.matrix.shape[1], others.matrix.shape[1])
    a, b = (
        np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m
        for m in (anchors.matrix, others.matrix)
    )
    return strassen(np.ascontiguousarray(a), np.ascontiguousarray(b.T))


def _first(scores: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` positions in ``among`` with the highest scores; ties by position."""
    if len(among) > k:
        values = scores[among]
        edge = np.partition(values, len(values) - k)[len(values) - k]
        among = among[values >= edge]
    return among[np.argsort(-scores[among], kind="stable")[:k]]


def _heap_batch(found: list[tuple], others: _Tile) -> pa.RecordBatch:
    """Rows of heaps: (anchor's row number, place, scores, positions)."""
    sizes = [len(at) for *_, at in found]
    at = np.concatenate([at for *_, at in found]) if found else np.zeros(0, np.int64)
    score = np.concatenate([s for _, _, s, _ in found]) if found else np.zeros(0, np.int64)
    anchor = np.repeat(np.array([f[0] for f in found], np.int64), sizes)
    place = np.repeat(np.array([f[1] for f in found], np.int32), sizes)
    ids = pa.array(others.ids[at], mask=others.given[at] == 0)
    return pa.RecordBatch.from_arrays(
        [pa.array(anchor), pa.array(place), pa.array(score), pa.array(others.nth[at]), ids],
        names=["anchor", "place", "score", "nth", "id"],
    )


def _positives(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            anchors, others = _Tile(batch, at, "_a"), _Tile(batch, at, "")
            scores, found = _scores(anchors, others), []
            for row in range(len(anchors.ids)):
                alike = (others.labels == anchors.labels[row]) & (others.nth != anchors.nth[row])
                best = _first(scores[row], np.flatnonzero(alike), k)
                found.append((anchors.nth[row], 0, scores[row][best], best))
            yield _heap_batch(found, others)


def _negatives(batches: Iterator[pa.RecordBatch], k: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        windows = batch.column(batch.schema.get_field_index("windows"))
        for at in range(batch.num_rows):
            anchors, others = _Tile(batch, at, "_a"), _Tile(batch, at, "")
            wanted = {w["anchor"]: w["scores"] for w in windows[at].as_py()}
            scores, found = _scores(anchors, others), []
            for row in range(len(anchors.ids)):
                nth, line = int(anchors.nth[row]), scores[row]
                differ = others.labels != anchors.labels[row]
                for place, score in enumerate(wanted.get(nth, ()), 1):
                    # Exact bounds of low * score <= 100 * x <= high * score.
                    least, most = -(-low * score // 100), high * score // 100
                    if least <= most:
                        inside = differ & (line >= least) & (line <= most)
                        best = _first(line, np.flatnonzero(inside), k)
                        found.append((nth, place, line[best], best))
            yield _heap_batch(found, others)


# --- the whole job -----------------------------------------------------------


def _usable(vector: Column) -> Column:
    """No null, NaN or infinity; and each scaled component fits a long."""
    wide = F.transform(vector, lambda x: x.cast("double") * F.lit(float(SCALE)))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= F.lit(float(1 << 63))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def _merged(heaps: DataFrame, keys: list[str], k: int, rank: str) -> DataFrame:
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("nth")]
    ranked = heaps.withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(rank) <= k)


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: Column | None = None,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    anchors_a_tile: int = 2048,
    rows_a_tile: int = 4096,
) -> DataFrame:
    """Per anchor and positive the best rows of other labels with a score in the positive's window.

    Rows: ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``,
    ``negative_score``. Components become ``floor(256 * x)``, scores are their integer inner products;
    higher ones come first, ties by id, null last. Positives are an anchor row's first ``positives``
    other rows of its label; a negative's score is from ``low`` to ``high`` percent of the positive's.

    Rows with a null label or vector, or with a component that is null, not finite or too large for a
    long when scaled take no part. A shorter vector counts as filled up with zeros; an empty one scores 0
    with all. Rows that repeat an id are rows of their own, also as anchors. ``anchor`` and ``label``
    are expressions over ``vectors``; a null ``anchor`` is none. An empty table, or one without anchors,
    gives no rows. Other columns are not looked at. Scores have to fit a long.
    """
    kept = vectors.where(_usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("id"),
        (F.col("label") if label is None else label).cast("long").alias("label"),
        F.transform(vector_col, lambda x: F.floor(x.cast("double") * F.lit(float(SCALE)))).alias("vector"),
        F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
        F.monotonically_increasing_id().alias("nth"),
    )
    kept = materialize(kept.where(F.col("label").isNotNull()), "vectors")
    sizes = kept.agg(F.count(F.lit(1)), F.count_if("is_anchor")).first()
    rows, row_tiles = _tiles(kept.drop("is_anchor"), sizes[0], rows_a_tile, "c")
    asked = kept.where("is_anchor").drop("is_anchor")
    anchors, anchor_tiles = _tiles(asked, sizes[1], anchors_a_tile, "a")

    cells = row_tiles * anchor_tiles
    tasks = max(min(cells, 64), -(-cells // 8))

    def all_of(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    right = rows.withColumn("a", all_of(anchor_tiles)).repartition(tasks, "a", "c")

    def grid(left: DataFrame) -> DataFrame:
        left = left.withColumnsRenamed({n: f"{n}_a" for n in left.columns if n not in ("a", "windows")})
        left = left.withColumn("c", all_of(row_tiles)).repartition(tasks, "a", "c")
        return left.join(right, ["a", "c"])

    found = grid(anchors).mapInArrow(lambda it: _positives(it, positives), HEAP)
    best = materialize(_merged(found, ["anchor"], positives, "place").select(
        "anchor", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    ), "positives")

    # Each anchor tile takes its own anchors' windows: at most anchors_a_tile lists of ``positives`` scores.
    names = asked.select("nth", F.col("id").alias("anchor_id"))
    home = anchors.select("a", F.explode("nth").alias("anchor"))
    lists = best.groupBy("anchor").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("place", "positive_score"))), lambda s: s["positive_score"]
        ).alias("scores")
    )
    windows = home.join(lists, "anchor").groupBy("a").agg(
        F.collect_list(F.struct("anchor", "scores")).alias("windows")
    )
    asked_tiles = anchors.join(windows, "a")
    found = grid(asked_tiles).mapInArrow(lambda it: _negatives(it, negatives, low, high), HEAP)
    hard = _merged(found, ["anchor", "place"], negatives, "rank")
    return (
        hard.select(
            "anchor", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
        )
        .join(best, ["anchor", "place"])
        .join(names.withColumnRenamed("nth", "anchor"), "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
