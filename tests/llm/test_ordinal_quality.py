from __future__ import annotations

import random

import numpy as np

from ledgerlark.llm import ordinal_quality as oq


def corpus(n, seed):
    """Grade 0 shouts, grade 1 has a rude word, grade 2 is plain."""
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdef" for b in ("lor", "mip", "sut", "den")]
    rows = []
    for i in range(n):
        grade = i % 3
        own = rng.choices(words, k=rng.randrange(20, 200))
        if grade == 1:
            own[rng.randrange(len(own))] = "rudeword"
        text = " ".join(own)
        rows.append((i, text.upper().replace(" ", "!! ") if grade == 0 else text, grade))
    return rows


def test_held_out_accuracy_and_order(spark, make):
    train, test = corpus(300, 1), corpus(90, 2)
    ratings = spark.createDataFrame([(i, g) for i, _, g in train], "doc_id long, grade int")
    model = oq.fit(make([r[:2] for r in train]), ratings, 3)
    assert (np.diff(model.thresholds) > 0).all()
    got = {r.doc_id: r for r in oq.grade(make([r[:2] for r in test]), model).collect()}
    right = sum(got[i].selected == (g == 2) for i, _, g in test)
    assert right >= 85
    means = [np.mean([got[i].expected_grade for i, _, g in test if g == k]) for k in range(3)]
    assert means[0] < means[1] < means[2]


def test_probabilities_fall_with_the_grade():
    model = oq.Model(np.zeros(1 << 17), np.array([-1.0, 0.5]), 17)
    above = model.above(0.2)
    assert above[0] > above[1] and 0 < above.min() and above.max() < 1


def test_awkward_rows(spark, awkward, make):
    ratings = spark.createDataFrame([(4, 2), (8, 0), (8, None), (None, 1), (6, 9)], "doc_id long, grade int")
    model = oq.fit(awkward, ratings, 3)
    out = oq.grade(awkward, model).collect()
    assert len(out) == 13
    assert all(r.expected_grade == 0 and not r.selected for r in out if r.doc_id in (1, 2, 3, 11))
    assert oq.grade(make([]), model).collect() == []
    none = ratings.where("grade > 5")
    assert oq.fit(awkward, none, 3) is None
    assert not any(r.selected for r in oq.grade(awkward, None).collect())
