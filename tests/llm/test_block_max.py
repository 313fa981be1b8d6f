from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from ledgerlark.llm import block_max


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    return [(i, " ".join(rng.choices(words, weights, k=rng.randrange(1, 60)))) for i in range(n)]


def brute(rows, queries, k):
    lists = {i: (t or "").lower().split() for i, t in rows}
    mean = max(1.0, sum(map(len, lists.values())) / len(lists))
    df = Counter(w for x in lists.values() for w in set(x))
    idf = {w: math.log(1 + (len(lists) - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    out = {}
    for q, text in queries:
        asked = Counter((text or "").lower().split())
        scores = {}
        for i, x in lists.items():
            tf = Counter(x)
            norm = 1.2 * (1 - 0.75 + 0.75 * len(x) / mean)
            s = sum(n * idf[w] * tf[w] * 2.2 / (tf[w] + norm) for w, n in asked.items() if tf[w])
            if s > 0:
                scores[i] = s
        out[q] = sorted(scores.items(), key=lambda p: (-round(p[1], 9), p[0]))[:k]
    return out


@pytest.mark.parametrize("shard_bytes", [1 << 20, 6000])
def test_same_as_all_scores(make, shard_bytes):
    rows = corpus(400)
    docs = make(rows)
    queries = [r for r in rows if r[0] % 50 == 0]
    got = {}
    for r in block_max.top_k(docs, make(queries), 10, shard_bytes=shard_bytes).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.doc_id, r.score))
    want = brute(rows, queries, 10)
    assert set(got) == {q for q, found in want.items() if found}
    for q, found in got.items():
        found.sort()
        assert [x[0] for x in found] == list(range(1, len(found) + 1))
        assert [x[2] for x in found] == pytest.approx([s for _, s in want[q]])
        assert [x[1] for x in found] == [i for i, _ in want[q]]


def test_blocks_are_left_closed():
    rng = np.random.default_rng(1)
    lists = [rng.integers(0, 1000, 30, dtype=np.uint64) + np.uint64(1000 * (i % 20)) for i in range(2000)]
    index = block_max.Shard(list(range(2000)), lists, 30.0)
    found = index.search(np.unique(lists[5]), np.ones(len(np.unique(lists[5]))), 3)
    assert found[0][0] == 5 and index.opened < index.blocks


def test_awkward_rows(awkward, make):
    out = block_max.top_k(awkward, awkward, 3).collect()
    asked = {r.query_id for r in out}
    assert not asked & {1, 2, 3, 11}
    assert [r.doc_id for r in sorted(out, key=lambda r: r["rank"]) if r.query_id == 8][:1] == [8]
    assert [r.doc_id for r in sorted(out, key=lambda r: r["rank"]) if r.query_id == 5] == [None, 4, 4]
    assert block_max.top_k(make([]), make([]), 3).collect() == []
    assert block_max.top_k(awkward, make([]), 3).collect() == []


def test_whole_texts_as_queries_open_few_blocks():
    """Common words, which all blocks share, don't open blocks that the rare ones rule out."""
    rng = np.random.default_rng(3)
    lists = [(rng.zipf(1.3, 300) % 20_000).astype(np.uint64) for _ in range(1500)]
    terms, df = np.unique(np.concatenate([np.unique(x) for x in lists]), return_counts=True)
    idf = np.log(1 + (len(lists) - df + 0.5) / (df + 0.5))
    index = block_max.Shard(list(range(1500)), lists, 300.0)
    asked = [np.unique(lists[i], return_counts=True) for i in range(0, 1500, 50)]
    asked = [(u, n * idf[np.searchsorted(terms, u)]) for u, n in asked]
    found = [index.search(u, w, 10) for u, w in asked]
    assert index.opened < 0.25 * index.blocks * len(asked)
    for (u, w), got in zip(asked, found, strict=True):
        scores = np.zeros(1500)
        for i, x in enumerate(lists):
            has, tf = np.unique(x, return_counts=True)
            at = np.minimum(np.searchsorted(u, has), len(u) - 1)
            scores[i] = (np.where(u[at] == has, w[at], 0.0) * tf * 2.2 / (tf + 1.2)).sum()
        best = np.lexsort((np.arange(1500), -scores.round(9)))[:10]
        assert [i for i, _ in got] == best.tolist() and [s for _, s in got] == pytest.approx(scores[best])


def test_rounds_grow_and_a_known_limit_bounds_the_rows():
    """A shard returns only what can still be among the best, so rows don't grow with shards times queries."""
    for size in (0, 1, 900, 10_000, 123_457):
        rounds = block_max._rounds(size, 1000)
        assert [a for a, _, _ in rounds] == [0, *(b for _, b, _ in rounds[:-1])]
        assert rounds[-1][1] == block_max.PLACES and all(a < b and n > 0 for a, b, n in rounds)
        assert sum(n for _, _, n in rounds) <= size / 1000 + len(rounds)
        assert len(rounds) <= 2 + np.log(max(1, size / 250)) / np.log(block_max.GROW)
    rng = np.random.default_rng(7)
    lists = [(rng.zipf(1.4, 80) % 3000).astype(np.uint64) for _ in range(4000)]
    parts = [block_max.Shard(list(range(a, a + 400)), lists[a : a + 400], 80.0) for a in range(0, 4000, 400)]
    asked, counts = np.unique(lists[9], return_counts=True)
    weights = counts * 1.5
    every = sorted((-s, i) for p in parts for i, s in p.search(asked, weights, 400))
    least = -every[9][0]
    found = [p.search(asked, weights, 10, least) for p in parts]
    assert sorted((-s, i) for x in found for i, s in x)[:10] == every[:10]
    assert sum(map(len, found)) == sum(-s >= least for s, _ in every) < 30


def test_queries_asked_together_share_the_sums_of_frequent_terms(monkeypatch):
    """Only lists of few documents are added up query by query; rows are those of queries asked alone."""
    rng = np.random.default_rng(11)
    lists = [(rng.zipf(1.3, 120) % 5000).astype(np.uint64) for _ in range(2000)]
    lists[100:300] = [lists[100]] * 200
    index = block_max.Shard(list(range(2000)), lists, 120.0)
    added = []
    sums = index._sums

    def counted(at, weights):
        added.extend(np.diff(index.list_start)[at].tolist())
        return sums(at, weights)

    monkeypatch.setattr(index, "_sums", counted)
    asked = [np.unique(lists[i], return_counts=True) for i in range(0, 2000, 20)]
    asked = [(u, n * rng.uniform(0.5, 3, len(u)), 0.0) for u, n in asked]
    asked += [(np.zeros(0, np.uint64), np.zeros(0), 0.0), (np.array([1 << 60], np.uint64), np.ones(1), 0.0)]
    together = index.search_all(asked, 10)
    assert max(added) <= block_max.FREQUENT * 2000
    assert together == [index.search(u, w, 10) for u, w, _ in asked] and together[-2:] == [[], []]
    copies = index.search(*asked[5][:2], 250)
    assert [i for i, _ in copies[:200]] == list(range(100, 300)) and len({s for _, s in copies[:200]}) == 1
    # Scored one by one or many at once, documents have the very same scores.
    assert copies[0] == together[5][0]
