from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import functions as F

from ledgerlark.llm import bbit_minhash
from ledgerlark.llm.components import components
from ledgerlark.llm.shingles import Signer


def brute(rows):
    sets = {}
    for i, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        n = min(5, len(w))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * len(sets[a] | sets[b]):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {(i, len(sets[i]), find(i), find(i) == i) for i in ids}


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    texts = []
    for _ in range(n):
        if texts and rng.random() < 0.7:
            words = rng.choice(texts).split()
            for _ in range(rng.randrange(6)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        else:
            words = rng.choices(vocabulary, k=rng.randrange(3, 120))
        texts.append(" ".join(words))
    return list(enumerate(texts))


def test_same_as_all_pairs(make):
    rows = corpus(1, 250)
    got = {tuple(r) for r in bbit_minhash.near_duplicates(make(rows)).collect()}
    assert got == brute(rows)


def test_awkward_rows(awkward):
    got = sorted(map(tuple, bbit_minhash.near_duplicates(awkward).collect()), key=str)
    assert len(got) == 13
    by = {r[0]: r[1:] for r in got}
    assert by[1] == (0, 1, True) and by[2] == (0, 2, True) and by[3] == (0, 3, True)
    # The row without an id comes first among equals, so its component has no number.
    assert by[4] == by[5] == (8, None, False) and by[None] == (8, None, True)
    assert by[7] == (29997, 6, False) and by[9] == (1, 8, False)


def test_empty_table(make):
    assert bbit_minhash.near_duplicates(make([])).collect() == []


def test_estimate_is_corrected_for_collisions(spark):
    signer = Signer(32, 4, 4)
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = pool[:2000], pool[1000:]  # similarity 1/3
    rows = [[signer.packed(signer.minima(x)).view(np.int64).tolist() for x in (a, b)]]
    df = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>")
    left, right = [df.a[i] for i in range(8)], [df.b[i] for i in range(8)]
    agree = bbit_minhash.matches(left, right, 128, 4)
    assert abs(df.select(bbit_minhash.similarity(agree, 128, 4)).first()[0] - 1 / 3) < 0.15


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 99)], "u long, v long")
    got = {tuple(r) for r in components(edges).collect()}
    assert got == {(i, 0) for i in range(1, 51)} | {(100, 99)}


def test_bitmaps_refuse_no_similar_pair(spark):
    rng = np.random.default_rng(5)
    rows, real = [], []
    for size in (1, 3, 40, 200, 5000):
        for share in (0.0, 0.5, 0.7, 0.74, 0.76, 0.8, 0.95, 1.0):
            a = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            b = np.concatenate([a[: round(size * share)], rng.integers(0, 1 << 63, round(size * (1 - share)), dtype=np.uint64)])
            a, b = np.unique(a), np.unique(b)
            both = len(np.intersect1d(a, b))
            real.append(100 * both >= 75 * (len(a) + len(b) - both))
            rows.append((len(real) - 1, len(a), len(b), bbit_minhash.bitmap(a).tolist(), bbit_minhash.bitmap(b).tolist()))
    df = spark.createDataFrame(rows, "i long, n long, m long, a array<bigint>, b array<bigint>")
    longs = range(bbit_minhash.MAP_LONGS)
    a, b = ([F.col(c)[i] for i in longs] for c in "ab")
    spares = [bbit_minhash.spare(F.col("n"), a), bbit_minhash.spare(F.col("m"), b)]
    possible = bbit_minhash.may_reach(a, b, F.col("n"), F.col("m"), *spares, 75)
    said = {r.i: r.p for r in df.select("i", possible.alias("p")).collect()}
    assert all(said[i] for i, r in enumerate(real) if r)
    assert sum(said[i] for i, r in enumerate(real) if not r) < sum(not r for r in real)
