"""Exact duplicates, shards and packing."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import chunk_recipes, hash_tree, slack_packing
from ledgerlark.llm.queries import WORD_TOKENIZER


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups["".join(c for c in text or "" if c not in " \t\n\v\f\r")].append((i, len(text or "")))
    out = []
    for own in groups.values():
        keep = min(own, key=lambda r: (-r[1], r[0]))[0]
        out += [(i, keep, len(own), i == keep) for i, _ in own]
    return sorted(out)


def texts():
    rng = random.Random(3)
    base = ["".join(rng.choices("ab. \n", k=rng.randrange(0, 2000))) for _ in range(20)]
    return [(i, rng.choice(base).replace(" ", rng.choice([" ", "  ", "\t", ""]))) for i in range(120)] + [(120, None)]


@pytest.mark.parametrize("hashed", [F.xxhash64, lambda c: F.length(c).cast("long")])
def test_exact_duplicates_also_when_hashes_collide(make, hashed):
    rows = texts()
    out = chunk_recipes.exact_duplicates(make(rows), min_chars=20, max_chars=60, hashed=hashed).collect()
    assert sorted(tuple(r[:4]) for r in out) == brute(rows)


def test_exact_duplicates_of_awkward_rows(awkward, make):
    out = chunk_recipes.exact_duplicates(awkward).collect()
    assert len(out) == 13
    assert {r.doc_id for r in out if r.keep_id == 3} == {1, 2, 3, 11}
    assert chunk_recipes.exact_duplicates(make([])).collect() == []


def test_shards_move_into_the_new_one_only(make):
    rows = [(i, "x" * (i % 7)) for i in range(3000)] + [(7, None), (None, "a")]
    out = hash_tree.shard_rows(make(rows), hash_tree.regular_tree(40)).collect()
    assert len(out) == len(rows)
    assert all(r.grown_shard in (r.shard, 40) for r in out)
    assert 20 < sum(r.grown_shard == 40 for r in out) < 150
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert hash_tree.shard_rows(make([]), hash_tree.regular_tree(40)).collect() == []


def test_packing_has_no_gap_and_no_overflow(awkward, make):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(WORD_TOKENIZER)
    source = defaultdict(list)
    for r in awkward.collect():
        source[r.doc_id].append(own.encode(r.text or "", add_special_tokens=False).ids + [0])
    out = slack_packing.pack(awkward, WORD_TOKENIZER).collect()
    places = defaultdict(list)
    for r in out:
        places[r.sequence_id].append((r.offset, r.length))
        whole = source[r.doc_id][0]
        cut = whole[r.start : r.start + r.length]
        assert r.start == r.piece * 2048 and len(cut) == r.length
        assert zlib.crc32(b"".join(x.to_bytes(4, "little") for x in cut)) == r.ids_crc32
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(len(x) for own in source.values() for x in own)
    assert sum(r.length for r in out) == total
    assert len(places) <= -(-total // 2048) + 1
    assert slack_packing.pack(make([]), WORD_TOKENIZER).collect() == []


def test_packing_against_the_fewest_bins():
    """Bins of the plan against the fewest possible, found by trying all ways of placing few pieces."""

    def fewest(pieces, room):
        best = len(pieces)

        def place(at, bins):
            nonlocal best
            if len(bins) >= best:
                return
            if at == len(pieces):
                best = len(bins)
                return
            for i in range(len(bins)):
                if bins[i] + pieces[at] <= room:
                    place(at + 1, [*bins[:i], bins[i] + pieces[at], *bins[i + 1 :]])
            place(at + 1, [*bins, pieces[at]])

        place(0, [])
        return best

    rng, more = random.Random(4), 0
    for _ in range(150):
        pieces = sorted(rng.choices(range(1, 21), k=rng.randrange(1, 10)), reverse=True)
        made = slack_packing.plan(Counter(pieces), 20)
        bins, placed = defaultdict(int), 0
        for length, rows in made.items():
            n = pieces.count(length)
            for (rank, first, per, _), until in zip(rows, [*(r[0] for r in rows[1:]), n], strict=True):
                for nth in range(until - rank):
                    bins[first + nth // per] += length
                    placed += 1
        assert placed == len(pieces) and max(bins.values()) <= 20
        more += len(bins) - fewest(pieces, 20)
    # The method is a greedy one: now and then it opens a bin more.
    assert 0 <= more <= 5
