"""Packing of documents into sequences of fixed length by minimum bin slack.

Tasks cut documents into pieces of at most ``capacity`` tokens. What a bin can hold depends on the
pieces' lengths alone, and there are at most ``capacity`` lengths, so the plan is made from the counts
per length: the longest piece left opens a bin, a subset-sum over bits finds the combination of the
lengths left that fills it best, and the combination is used as often as its lengths last. Each step
uses up at least one length, so there are at most ``capacity`` steps whatever the corpus' size. Every
piece then finds its place from its rank among the pieces of its length; the plan has a bounded size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.numbering import number_within, parts_for
from ledgerlark.llm.prefix_bpe import LibraryEncoder, encoder
from ledgerlark.sources.scratch import BATCH_ROWS, materialize

CAPACITY = 2048
END_ID = 0
PIECES = "id long, piece int, start long, length long, ids_crc32 long"


def fullest(counts: np.ndarray, lengths: list[int], room: int) -> dict[int, int]:
    """The combination of ``lengths`` (each at most ``counts[length]`` times) that fills ``room`` best.

    Bit ``s`` of a number says whether the sum ``s`` can be reached. Lengths come from the longest on,
    and the first full sum ends the search, so long pieces are used up first.
    """
    if room <= 0:
        return {}
    mask, reach = (1 << (room + 1)) - 1, 1
    steps: list[tuple[int, int, int]] = []  # length, copies, sums reachable before
    for length in lengths:
        left, copies = min(int(counts[length]), room // length), 1
        while left:
            take = min(copies, left)
            steps.append((length, take, reach))
            reach = (reach | reach << (length * take)) & mask
            left -= take
            copies *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    used: dict[int, int] = {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + take
            total -= length * take
    return used


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> dict[int, list[tuple[int, ...]]]:
    """For each length, in order of rank: ``(first rank, first bin, pieces per bin, offset)``.

    The pieces of that length from the first rank up to the next entry's are dealt to consecutive bins,
    ``pieces per bin`` each, side by side from ``offset`` on.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    given = np.zeros(capacity + 1, dtype=np.int64)
    out: dict[int, list[tuple[int, ...]]] = {}
    bins = 0
    lengths = [int(x) for x in np.flatnonzero(left)[::-1]]
    while lengths:
        longest = lengths[0]
        left[longest] -= 1
        used = fullest(left, [x for x in lengths if x <= capacity - longest], capacity - longest)
        left[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        times = min(int(left[x]) // n for x, n in used.items())
        offset = 0
        for length in sorted(used, reverse=True):
            n = used[length]
            out.setdefault(length, []).append((int(given[length]), bins, n, offset))
            given[length] += n * times
            left[length] -= n * times
            offset += n * length
        bins += times
        lengths = [x for x in lengths if left[x]]
    return out


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int) -> Iterator[pa.RecordBatch]:
    names = ["id", "piece", "start", "length", "ids_crc32"]
    encode = encoder(path, LibraryEncoder).ids
    for batch in batches:
        ids, pieces, starts, lengths, sums = [], [], [], [], []
        for key, text in zip(batch.column(0), batch.column(1), strict=True):
            data = text.as_buffer() if text.is_valid else b""
            tokens = np.append(encode(bytes(data)), END_ID).astype("<u4")
            for piece, start in enumerate(range(0, len(tokens), capacity)):
                cut = tokens[start : start + capacity]
                ids.append(key.as_py())
                pieces.append(piece)
                starts.append(start)
                lengths.append(len(cut))
                sums.append(zlib.crc32(cut.tobytes()))
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        columns = [ids, pieces, starts, lengths, sums]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
        )


def _placed(
    batches: Iterator[pa.RecordBatch], made: dict[int, list[tuple[int, ...]]]
) -> Iterator[pa.RecordBatch]:
    arrays = {length: np.array(rows, dtype=np.int64) for length, rows in made.items()}
    for batch in batches:
        length = batch.column("length").to_numpy()
        rank = batch.column("rank").to_numpy()
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for value in np.unique(length):
            mine, table = np.flatnonzero(length == value), arrays[int(value)]
            row = table[np.searchsorted(table[:, 0], rank[mine], "right") - 1]
            nth = rank[mine] - row[:, 0]
            sequence[mine] = row[:, 1] + nth // row[:, 2]
            offset[mine] = row[:, 3] + nth % row[:, 2] * value
        kept = [batch.column(n) for n in ("id", "piece", "start", "length", "ids_crc32")]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(sequence), pa.array(offset)],
            names=["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
        )


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    A document is its text's ids and a closing 0; a null or empty text has the 0 alone. Only documents
    of more than ``capacity`` ids are cut. Every sequence holds at most ``capacity`` ids, offsets have
    no gap. Rows that repeat an id are packed each for themselves; a null id is carried along. Other
    columns are not looked at.
    """
    texts = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text")
    )
    pieces = texts.mapInArrow(lambda it: _pieces(it, tokenizer_path, capacity), PIECES)
    pieces = materialize(pieces, "pieces", BATCH_ROWS)
    # At most ``capacity`` rows, whatever the corpus' size.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    made = plan(counts, capacity)
    order = ["id", "piece", "ids_crc32", "start"]
    ranked = number_within(pieces, ["length"], order, "rank", parts_for(sum(counts.values())))
    placed = ranked.mapInArrow(
        lambda it: _placed(it, made), f"{PIECES}, sequence_id long, offset long"
    )
    return placed.withColumnRenamed("id", id_col)
