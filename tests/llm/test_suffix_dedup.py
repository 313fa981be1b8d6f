from __future__ import annotations

import random

import numpy as np
import pytest

from ledgerlark.llm.suffix_dedup import remove_repeats
from ledgerlark.llm.suffix_sort import rank_windows


def brute(rows, window):
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for s in range(len(data) - window + 1):
            piece = data[s : s + window]
            if piece in seen:
                gone[s : s + window] = True
            seen.add(piece)
        spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(data) else 0
        out[i] = (len(data), int(gone.sum()), spans, bytes(np.frombuffer(data, np.uint8)[~gone]))
    return out


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["né", "the", "of", "straße", "x", "word", "other"]
    passages = [" ".join(rng.choices(words, k=rng.randrange(5, 60))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(rng.choices(words, k=30)) for _ in range(5)]
        rows.append((i, "\n".join(parts)))
    return rows + [(n, None), (n + 1, ""), (n + 2, "a" * 500), (n + 3, "a" * 300 + "b" * 300)]


@pytest.mark.parametrize("window, anchor, group", [(100, 32, 8 << 20), (100, 32, 4000), (20, 8, 4000)])
def test_same_as_all_windows(make, window, anchor, group):
    rows = corpus(window + group, 80)
    random.Random(1).shuffle(rows)
    made = remove_repeats(make(rows).repartition(3), window=window, anchor=anchor, group_bytes=group)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in made.collect()}
    assert got == brute(rows, window)


def test_awkward_rows(awkward):
    got = remove_repeats(awkward, carry=["lang", "n_chars"], whole_characters=True).collect()
    assert len(got) == 13
    by = {r.doc_id: r for r in got}
    assert by[1].n_bytes == by[2].n_bytes == 0 and bytes(by[1].kept) == b""
    assert bytes(by[7].kept) == b"" or by[7].n_removed > 100_000
    assert by[6].n_removed == 0


def test_empty_table(make):
    assert remove_repeats(make([])).collect() == []


def test_ranks_follow_the_bytes():
    data = np.random.default_rng(3).integers(97, 99, 4000, dtype=np.uint8)
    data[2000:2500] = data[100:600]
    starts = np.arange(len(data) - 100)
    rank = rank_windows(data, starts, 100)
    whole = data.tobytes()
    order = sorted(starts.tolist(), key=lambda s: whole[s : s + 100])
    for a, b in zip(order, order[1:], strict=False):
        assert (rank[a] == rank[b]) == (whole[a : a + 100] == whole[b : b + 100])
        assert rank[a] <= rank[b]


def test_repeated_rows_are_one_document(make):
    """Rows of one id and text, with and without an id, in one batch and in several."""
    rng = random.Random(9)
    text = lambda: " ".join(f"{rng.randrange(10**6)}" for _ in range(40))
    a, b, c, d = text(), text(), text(), text()
    rows = [(1, a + b), (2, c + a), (None, d), (3, b + d)]
    want = brute([(-(1 << 63) if i is None else i, t) for i, t in rows], 100)
    for parts in (1, 6):
        docs = make([*rows, *rows, (2, c + a), (None, d)]).repartition(parts)
        got = remove_repeats(docs).collect()
        assert len(got) == 10
        for r in got:
            key = -(1 << 63) if r.doc_id is None else r.doc_id
            assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == want[key]


def test_texts_of_one_id_with_equal_short_hashes(make, spark):
    """Two texts without an id whose 32-bit hashes are equal are two documents."""
    rows = colliding_texts(spark)
    docs = make([(None, rows[0]), (None, rows[1]), (1, rows[0]), (2, rows[1])])
    got = remove_repeats(docs).collect()
    alone = {len(t): brute([(0, t)], 100)[0] for t in rows}
    assert alone[len(rows[0])][1] > 200 and alone[len(rows[1])][1] == 0
    for r in got:
        want = alone[r.n_bytes] if r.doc_id is None else (r.n_bytes, r.n_bytes, 1, b"")
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == want
    assert len(got) == 4


def colliding_texts(spark):
    """A text that repeats itself and a shorter one with equal ``hash``, found by trying numbers at the end."""
    from pyspark.sql import functions as F

    rng = random.Random(12)
    heads = [" ".join(f"{rng.randrange(10**6)}" for _ in range(k)) for k in (40, 20)]
    heads[0] += " " + heads[0]
    texts = spark.range(200_000).withColumn("text", F.concat(F.lit(heads[0] + " "), F.col("id").cast("string")))
    other = spark.range(200_000).withColumn("text", F.concat(F.lit(heads[1] + " "), F.col("id").cast("string")))
    a = texts.select(F.hash("text").alias("h"), F.col("text").alias("a"))
    b = other.select(F.hash("text").alias("h"), F.col("text").alias("b"))
    return tuple(a.join(b, "h").select("a", "b").orderBy("a", "b").first())
