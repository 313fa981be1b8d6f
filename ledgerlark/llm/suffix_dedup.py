"""Removal of bytes that lie in a 100-byte string which also starts earlier in the corpus.

Sorting all suffixes of a corpus would move every byte a hundred times. Windows that can be equal are
brought together first: every window is assigned to the smallest hash among its ``ANCHOR``-byte strings,
a choice that depends on the window's bytes alone, so equal windows have the same anchor. A run of
windows of one document with the same anchor is a *context*.

1. Tasks send each context as an anchor hash, a hash of its bytes and its place (23 bytes for about 35
   bytes of text). Of contexts that are equal within a batch only the first is sent, so a hot passage
   or copy sends one per batch.
2. Per bucket of anchors, later equal contexts are covered. Anchors left with several different
   contexts ask for the bytes of those (about a fifth of the text at most in prose without copies).
3. Documents and requests meet by document group, and the bytes of the asked contexts are sent to their
   anchor's bucket, where deep-shallow sorting brings equal windows together; all but the first of each
   are covered.
4. Documents meet what is covered in them, again by document group: the same shuffle of the texts.

Buckets and groups are numbered in proportion to the corpus' bytes, so a task's memory does not grow, but
for the contexts of one anchor that stands in a large share of the documents and rows equal in id and text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.llm.suffix_sort import rank_windows
from ledgerlark.llm.text_bytes import flat, mix, prefix_sums, range_hashes
from ledgerlark.sources.scratch import BATCH_ROWS, materialize

WINDOW = 100
ANCHOR = 32
SEGMENT = 1 << 18
GROUP_BYTES = 8 << 20

# A document is its id and 128 bits of its text's digest; the digest also orders the texts of one id.
KEY = [("k", "<i8"), ("r", "<u8"), ("q", "<u8")]
NAMES = [name for name, _ in KEY]
DOC = np.dtype([*KEY, ("dg", "<i4")])
SPAN = np.dtype([*KEY, ("lo", "<i4"), ("n", "<u2")])
ASK = np.dtype([*KEY, ("lo", "<i4"), ("n", "<u2"), ("h", "<u8")])
SENT = np.dtype([("h", "<u8"), *KEY, ("dg", "<i4"), ("lo", "<i4"), ("n", "<u2")])
DECIDED = "dg int, kind int, data binary"
COVERED, ASKED = 0, 1


def _anchors(data: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix sums, anchor hashes by position, and the anchor's position for each window start."""
    sums = prefix_sums(data)
    at = np.arange(len(data) - anchor + 1)
    hashes = range_hashes(sums, at, at + anchor)
    low = np.uint64(24)
    least = (hashes >> low << low) | at.astype(np.uint64)
    wide, span = window - anchor + 1, 1
    while span * 2 <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if wide > span:
        least = np.minimum(least[: len(least) - (wide - span)], least[wide - span :])
    return sums, hashes, (least & np.uint64((1 << 24) - 1)).astype(np.int64)


def contexts(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR):
    """``(doc, lo, n, h, g)`` of all contexts of the documents between ``offsets``, in their order.

    ``n`` windows start from ``lo`` on in document ``doc``; ``h`` is their anchor's hash, ``g`` that of
    all their bytes. Long documents are worked on in segments, which may cut a context in two.
    """
    sizes = np.diff(offsets)
    pieces: list[tuple[int, int, int, int]] = []  # first document, last, start, end of a segment
    i = 0
    while i < len(sizes):
        if sizes[i] > SEGMENT:
            for start in range(0, int(sizes[i]) - window + 1, SEGMENT):
                end = min(int(sizes[i]), start + SEGMENT + window - 1)
                pieces.append((i, i + 1, int(offsets[i]) + start, int(offsets[i]) + end))
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SEGMENT, "right")) - 1)
        pieces.append((i, j, int(offsets[i]), int(offsets[j])))
        i = j
    out = []
    for i, j, start, end in pieces:
        part = data[start:end]
        if len(part) < window:
            continue
        sums, hashes, where = _anchors(part, window, anchor)
        inner = np.clip(offsets[i : j + 1] - start, 0, len(part))
        doc = np.repeat(np.arange(i, j), np.diff(inner))[: len(where)]
        s = np.flatnonzero(np.arange(len(where)) + window <= inner[1:][doc - i])
        if not len(s):
            continue
        where, doc = where[s], doc[s]
        new = np.ones(len(s), dtype=bool)
        new[1:] = (where[1:] != where[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(s)) - 1
        lo, hi, doc = s[first], s[last], doc[first]
        g = range_hashes(sums, lo, hi + window)
        out.append((doc, lo + start - offsets[doc], hi - lo + 1, hashes[where[first]], g))
    if not out:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _packed(records: np.ndarray, by: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    if not len(by):
        return
    order = np.argsort(by, kind="stable")
    values, starts = np.unique(by[order], return_index=True)
    for value, own in zip(values.tolist(), np.split(order, starts[1:]), strict=True):
        yield value, records[own]


def _rows(names: Sequence[str], types: Sequence[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=list(names))


def _digests(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of each digest of a column."""
    both = flat(column)[0].view(">u8").astype("<u8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where a row of sorted columns differs from the row before it."""
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = False
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return new


def _send_contexts(batches, buckets: int, window: int, anchor: int):
    """Per batch and bucket: documents, contexts that are the first of their kind in the batch, and
    places of those that are not."""
    for batch in batches:
        key = batch.column("k").to_numpy()
        row = _digests(batch.column("r"))
        order = np.lexsort((row[1], row[0], key))
        # A row that repeats id and text is the same document: its windows are no later copies.
        order = order[_heads(key[order], row[0][order], row[1][order])]
        docs = np.zeros(len(order), DOC)
        docs["k"], docs["r"], docs["q"] = key[order], row[0][order], row[1][order]
        docs["dg"] = batch.column("dg").to_numpy()[order]
        data, offsets = flat(batch.column("text").take(pa.array(order)))
        doc, lo, n, h, g = contexts(data, offsets, window, anchor)
        # Documents stand in their order, so the first of equals is the earliest.
        both = h ^ mix(g)
        order = np.argsort(both, kind="stable")
        again = np.zeros(len(order), dtype=bool)
        again[order[1:]] = both[order[1:]] == both[order[:-1]]
        rows = []
        bucket = (h >> np.uint64(32)) % np.uint64(buckets)
        bucket[again] = docs["dg"][doc[again]] % buckets
        for value, own in _packed(np.arange(len(h)), bucket.astype(np.int64)):
            late = again[own]
            span = np.zeros(int(late.sum()), SPAN)
            gone = own[late]
            for name in NAMES:
                span[name] = docs[name][doc[gone]]
            span["lo"], span["n"] = lo[gone], n[gone]
            own = own[~late]
            used, index = np.unique(doc[own], return_inverse=True)
            rows.append((
                value,
                docs[used].tobytes(),
                h[own].tobytes(),
                g[own].tobytes(),
                index.astype("<u4").tobytes(),
                lo[own].astype("<i4").tobytes(),
                n[own].astype("<u2").tobytes(),
                span.tobytes(),
                docs["dg"][doc[gone]].tobytes(),
            ))
        names = ["bucket", "docs", "h", "g", "at", "lo", "n", "late", "late_dg"]
        yield _rows(names, [pa.int32(), *[pa.binary()] * 8], rows)


CONTEXTS = (
    "bucket int, docs binary, h binary, g binary, at binary, lo binary, n binary,"
    " late binary, late_dg binary"
)


def _column(table: pa.Table, name: str, dtype) -> np.ndarray:
    """A binary column's rows, one after the other, as one array."""
    data, _ = flat(table.column(name))
    return np.frombuffer(data.tobytes(), dtype=dtype)


def _decide(table: pa.Table) -> pa.Table:
    """Later equal contexts of a bucket as covered, differing contexts of one anchor as asked for."""
    docs, h = _column(table, "docs", DOC), _column(table, "h", "<u8")
    g, lo, n = _column(table, "g", "<u8"), _column(table, "lo", "<i4"), _column(table, "n", "<u2")
    at = _column(table, "at", "<u4").astype(np.int64)
    _, doc_ends = flat(table.column("docs"))
    _, record_ends = flat(table.column("h"))
    at += np.repeat(doc_ends[:-1] // DOC.itemsize, np.diff(record_ends) // 8)
    late = _column(table, "late", SPAN)
    rows = [
        (dg, COVERED, spans.tobytes())
        for dg, spans in _packed(late, _column(table, "late_dg", "<i4"))
    ]
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    repeated = np.zeros(len(h), dtype=bool)
    repeated[order[1:][same]] = repeated[order[:-1][same]] = True
    own = np.flatnonzero(repeated)
    doc = docs[at[own]]
    order = np.lexsort((lo[own], doc["q"], doc["r"], doc["k"], g[own], h[own]))
    own, doc = own[order], doc[order]
    # A context of a repeated row comes once per batch that has the row: it is one and the same.
    once = _heads(h[own], g[own], *(doc[n] for n in NAMES), lo[own])
    own, doc = own[once], doc[once]
    new_h = np.ones(len(own), dtype=bool)
    new_h[1:] = h[own[1:]] != h[own[:-1]]
    new = new_h.copy()
    new[1:] |= g[own[1:]] != g[own[:-1]]
    kinds = np.bincount(np.cumsum(new_h) - 1, weights=new) if len(own) else np.zeros(0)
    several = (kinds > 1)[np.cumsum(new_h) - 1] if len(own) else new
    for kind, dtype, mask in ((COVERED, SPAN, ~new), (ASKED, ASK, new & several)):
        made = np.zeros(int(mask.sum()), dtype)
        for name in NAMES:
            made[name] = doc[name][mask]
        made["lo"], made["n"] = lo[own[mask]], n[own[mask]]
        if kind == ASKED:
            made["h"] = h[own[mask]]
        rows += [(dg, kind, x.tobytes()) for dg, x in _packed(made, doc["dg"][mask])]
    batch = _rows(["dg", "kind", "data"], [pa.int32(), pa.int32(), pa.binary()], rows)
    return pa.Table.from_batches([batch])


def _by_document(texts: pa.Table, records: np.ndarray):
    """For each row of ``texts`` that has any: its number and its records, in order of ``lo``."""
    if not len(records):
        return
    records = records[np.lexsort((records["lo"], records["q"], records["r"], records["k"]))]
    first = np.flatnonzero(_heads(*(records[n] for n in NAMES)))
    last = np.append(first[1:], len(records))
    places = {
        tuple(int(records[n][a]) for n in NAMES): (int(a), int(b))
        for a, b in zip(first, last, strict=True)
    }
    r, q = _digests(texts.column("r"))
    keys = zip(texts.column("k").to_pylist(), r.tolist(), q.tolist(), strict=True)
    for i, key in enumerate(keys):
        if key in places:
            a, b = places[key]
            yield i, records[a:b]


def _send_bytes(texts: pa.Table, asked: pa.Table, buckets: int, window: int) -> pa.Table:
    """The bytes of the asked contexts, by their anchor's bucket."""
    names, types = ["bucket", "sent", "bytes"], [pa.int32(), pa.binary(), pa.binary()]
    rows = []
    if len(texts) and len(asked):
        data, offsets = flat(texts.column("text"))
        dg = texts.column("dg")[0].as_py()
        sent, starts, seen = [], [], set()
        for i, own in _by_document(texts, _column(asked, "data", ASK)):
            if (mark := tuple(int(own[n][0]) for n in NAMES)) in seen:
                continue  # a repeated row
            seen.add(mark)
            one = np.zeros(len(own), SENT)
            for name in ("h", *NAMES, "lo", "n"):
                one[name] = own[name]
            one["dg"] = dg
            sent.append(one)
            starts.append(offsets[i] + own["lo"].astype(np.int64))
        if sent:
            sent, starts = np.concatenate(sent), np.concatenate(starts)
            bucket = ((sent["h"] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            for value, own in _packed(np.arange(len(sent)), bucket):
                sizes = sent["n"][own].astype(np.int64) + window - 1
                ends = np.cumsum(sizes)
                at = np.arange(ends[-1]) + np.repeat(starts[own] - ends + sizes, sizes)
                rows.append((value, sent[own].tobytes(), data[at].tobytes()))
    return pa.Table.from_batches([_rows(names, types, rows)])


def _sort_bucket(table: pa.Table, window: int) -> pa.Table:
    """Windows of a bucket that are equal to an earlier one, as covered."""
    sent, data = _column(table, "sent", SENT), _column(table, "bytes", np.uint8)
    n = sent["n"].astype(np.int64)
    sizes = n + window - 1
    begin = np.cumsum(sizes) - sizes
    context = np.repeat(np.arange(len(sent)), n)
    nth = np.arange(len(context)) - np.repeat(np.cumsum(n) - n, n)
    rank = rank_windows(data, begin[context] + nth, window)
    # Documents as numbers in their order: a window then has one number for its document.
    order = np.lexsort((sent["q"], sent["r"], sent["k"]))
    number = np.zeros(len(sent), np.int64)
    number[order] = np.cumsum(_heads(*(sent[name][order] for name in NAMES)))
    order = np.lexsort((sent["lo"][context] + nth, number[context], rank))
    later = np.zeros(len(order), dtype=bool)
    later[order[1:]] = rank[order[1:]] == rank[order[:-1]]
    # Neighbouring windows of a context make one span.
    at = np.flatnonzero(later)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (np.diff(at) != 1) | (context[at[1:]] != context[at[:-1]])
    first = np.flatnonzero(new)
    spans = np.zeros(len(first), SPAN)
    head = at[first]
    doc = sent[context[head]]
    for name in NAMES:
        spans[name] = doc[name]
    spans["lo"] = doc["lo"] + nth[head]
    spans["n"] = np.diff(np.append(first, len(at)))
    rows = [(dg, COVERED, x.tobytes()) for dg, x in _packed(spans, doc["dg"])]
    batch = _rows(["dg", "kind", "data"], [pa.int32(), pa.int32(), pa.binary()], rows)
    return pa.Table.from_batches([batch])


def _cut(texts: pa.Table, covered: pa.Table, window: int, whole_characters: bool) -> pa.Table:
    """The documents of a group without their covered bytes."""
    data, offsets = flat(texts.column("text"))
    removed = np.zeros(len(texts), np.int64)
    spans = np.zeros(len(texts), np.int64)
    kept: dict[int, bytes] = {}
    if len(texts) and len(covered):
        for i, own in _by_document(texts, _column(covered, "data", SPAN)):
            lo = own["lo"].astype(np.int64)
            hi = np.maximum.accumulate(lo + own["n"] + window - 1)
            new = np.append(True, lo[1:] > hi[:-1])
            begin, end = lo[new], hi[np.append(new[1:], True)]
            text = data[offsets[i] : offsets[i + 1]]
            if whole_characters:
                # A character of which only a part is covered stays.
                starts = (text & 0xC0) != 0x80
                edge = np.append(np.flatnonzero(starts), len(text))
                begin = edge[np.searchsorted(edge, begin, "left")]
                end = edge[np.searchsorted(edge, end, "right") - 1]
                begin, end = begin[begin < end], end[begin < end]
            step = np.zeros(len(text) + 1, np.int8)
            step[begin] += 1
            step[end] -= 1
            gone = np.cumsum(step[:-1], dtype=np.int8) > 0
            removed[i], spans[i], kept[i] = gone.sum(), len(begin), text[~gone].tobytes()
    text = texts.column("text").combine_chunks().fill_null(b"")
    if kept:
        text = pa.array([kept.get(i) or (b"" if i in kept else text[i].as_py()) for i in range(len(texts))], pa.binary())
    names = [n for n in texts.column_names if n.startswith("c")]
    made = [pa.array(np.diff(offsets)), pa.array(removed), pa.array(spans), text]
    return pa.Table.from_arrays(
        [*(texts.column(n) for n in names), *made],
        names=[*names, "n_bytes", "n_removed", "n_spans", "kept"],
    )


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = (),
    window: int = WINDOW,
    anchor: int = ANCHOR,
    whole_characters: bool = False,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: id, the ``carry`` columns, ``n_bytes``, ``n_removed``, ``n_spans``
    and ``kept`` (binary).

    Every byte goes that lies in a ``window``-byte string which also starts earlier: in a document of
    smaller id, or earlier in the same one. Strings do not cross documents and are judged on the texts
    as given. With ``whole_characters`` a character that is covered in part stays, so that what is
    kept is UTF-8. A null text counts as empty. Of rows that share an id the texts are ordered by
    their hash, and a null id comes first. Rows equal in both are one document: none of them is an
    earlier copy of another, and they get the same result.
    """
    if not 8 <= anchor < window:
        raise ValueError("the anchor has at least 8 bytes and is shorter than the window")
    size = docs.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    parts = max(1, -(-size // group_bytes))
    carried = [id_col, *carry]
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    keyed = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("k"),
        F.unhex(F.substring(F.sha2(text, 256), 1, 32)).alias("r"),
        text.alias("text"),
        *(F.col(c).alias(f"c{i}") for i, c in enumerate(carried)),
    ).withColumn("dg", F.pmod(F.xxhash64("k", "r"), F.lit(parts)).cast("int"))
    found = keyed.select("dg", "k", "r", "text").mapInArrow(
        lambda it: _send_contexts(it, parts, window, anchor), CONTEXTS
    )
    decided = materialize(found.groupBy("bucket").applyInArrow(_decide, DECIDED), "contexts", BATCH_ROWS)
    # Both meetings with the texts use the same columns, hence one shuffle of them.
    asked = decided.where(F.col("kind") == ASKED)
    sent = (
        keyed.groupBy("dg")
        .cogroup(asked.groupBy("dg"))
        .applyInArrow(
            lambda a, b: _send_bytes(a, b, parts, window), "bucket int, sent binary, bytes binary"
        )
    )
    sorted_ = sent.groupBy("bucket").applyInArrow(lambda t: _sort_bucket(t, window), DECIDED)
    covered = decided.where(F.col("kind") == COVERED).unionByName(sorted_)
    fields = [T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(carried)]
    fields += [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
    fields.append(T.StructField("kept", T.BinaryType()))
    cut = (
        keyed.groupBy("dg")
        .cogroup(covered.groupBy("dg"))
        .applyInArrow(lambda a, b: _cut(a, b, window, whole_characters), T.StructType(fields))
    )
    names = {f"c{i}": c for i, c in enumerate(carried)}
    return cut.select(*(F.col(f.name).alias(names.get(f.name, f.name)) for f in fields))
