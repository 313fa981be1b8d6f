"""Merkle manifests against trees built one node at a time."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import merkle_manifest as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    parts = ["-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in M.FIELDS]
    return sha("".join(parts))


def tree(nodes, fan):
    """Root and, per leaf, the siblings before and after on each level."""
    paths, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        parents, owned = [], []
        for a in range(0, len(nodes), fan):
            run = nodes[a : a + fan]
            for j in range(len(run)):
                for leaf in below[a + j]:
                    paths[leaf].append(("".join(run[:j]), "".join(run[j + 1 :])))
            parents.append(sha("".join(run)))
            owned.append([leaf for own in below[a : a + fan] for leaf in own])
        nodes, below = parents, owned
    return nodes[0], paths


def brute(rows, fan, spoil):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append((row["doc_id"], leaf_of(row), row))
    ordered = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in ordered:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees.append(tree([r[1] for r in groups[g]], fan))
    root, tops = tree([t[0] for t in trees], fan) if trees else (None, [])
    out = []
    for g, (subroot, paths), top in zip(ordered, trees, tops, strict=True):
        for (doc_id, leaf, row), path in zip(groups[g], paths, strict=True):
            steps = path + top
            up = leaf_of({**row, "text": spoil(row["text"])})
            for before, after in steps:
                up = sha(before + up + after)
            proof = sha("".join(b + a for b, a in steps))
            out.append((doc_id, leaf, subroot, root, proof, up, up == root))
    return out


def run(docs, fan, depth):
    changed = F.when(F.col("text").startswith("A"), M.lower_ascii(F.col("text"))).otherwise(F.col("text"))
    out = M.manifest(docs, tampered={"text": changed}, fan=fan, depth=depth)
    proof = M.proof_digest(F.col("steps"))
    rows = out.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def spoil(text):
    return text.lower() if text and text.startswith("A") else text


def case(rng, n, langs):
    texts = ["", "Abc", "abc", "é|ß", None, "A" * 50_000]
    rows = [(rng.choice([None, *range(n)]), rng.choice(texts), rng.choice(langs), "s", rng.choice([None, 3]))
            for _ in range(n)]
    return rows + rows[: n // 3]


@pytest.mark.parametrize(
    ("n", "langs", "fan", "depth"),
    [(0, ["en"], 8, 4), (1, ["en"], 8, 4), (1, [None, "é", "z", "a"], 8, 4), (70, ["en", None], 8, 1),
     (90, ["en", "de", None, "é", "z", "ab", "a", "x", "y", "q"], 2, 2), (300, [None], 3, 2)],
)
def test_equals_trees_built_node_by_node(spark, n, langs, fan, depth):
    rows = case(random.Random(n), n, langs)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    want = brute([dict(zip(names, r, strict=True)) for r in rows], fan, spoil)
    got = run(docs, fan, depth)
    # Rows equal in all fields share a leaf; which of them has which place is open, the places are not.
    assert got == sorted(want, key=repr)


def test_only_changed_rows_fail(awkward):
    plain = M.manifest(awkward).collect()
    assert len(plain) == 13 and all(r.verified for r in plain)
    changed = M.manifest(awkward, tampered={"text": M.lower_ascii(F.col("text"))}).collect()
    assert {r.doc_id for r in changed if not r.verified} == {9}
    assert {r.root for r in changed} == {r.root for r in plain}


def test_extra_columns_of_any_name_are_not_looked_at(awkward):
    extra = awkward
    for name in ("key", "idx", "node", "chunk", "steps", "up", "total", "nth", "leaf", "root", "row", "part"):
        extra = extra.withColumn(name, F.lit("x"))
    assert {r.root for r in M.manifest(extra).collect()} == {r.root for r in M.manifest(awkward).collect()}


def test_a_tree_needs_a_fan(awkward):
    with pytest.raises(ValueError, match="fan"):
        M.manifest(awkward, fan=1)
