from __future__ import annotations

import math
import random
from collections import Counter

from ledgerlark.llm import ppm_language

WORDS = {"en": ["the", "thing", "of", "ship"], "de": ["der", "schiff", "über", "ding"], "fr": ["le", "navire", "où", "été"]}


def brute_bits(training, text, order):
    """Code length of ``text`` after counting each run of ``training``, one byte at a time."""
    counts = {}
    for one in training:
        data = bytes(order) + one.lower().encode()
        for i in range(order, len(data)):
            for k in range(order + 1):
                run = data[i - k : i + 1]
                counts.setdefault(run[:-1], Counter())[run[-1]] += 1
    bits, data = 0.0, bytes(order) + text.lower().encode()
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            seen = counts.get(data[i - k : i])
            if seen is None:
                continue
            total = sum(seen.values()) + len(seen)
            if data[i] in seen:
                bits -= math.log2(seen[data[i]] / total)
                break
            bits -= math.log2(len(seen) / total)
        else:
            bits += 8
    return bits


def corpus(make, spark, n=120):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(WORDS))
        rows.append((i, " ".join(rng.choices(WORDS[lang], k=rng.randrange(3, 40))).capitalize(), lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows


def test_code_lengths_same_as_one_byte_at_a_time(make, spark):
    docs, rows = corpus(make, spark, 24)
    model = ppm_language.fit(docs, order=3)
    texts = ["the thing über", "Été", "zz§"]
    got = model.text_bits(texts)
    for i, name in enumerate(model.languages):
        training = sorted({t for _, t, lang in rows if lang == name})
        for j, text in enumerate(texts):
            assert abs(got[j, i] - brute_bits(training, text, 3)) < 1e-6


def test_held_out_accuracy(make, spark):
    docs, rows = corpus(make, spark)
    truth = {i: lang for i, _, lang in rows}
    out = ppm_language.identify(docs).collect()
    held = [r for r in out if r.held_out]
    assert len(out) == len(rows) and held
    assert all(r.lang_pred == truth[r.doc_id] and 0 <= r.score <= 1 for r in held)


def test_long_texts_are_scored_whole(make, spark, monkeypatch):
    docs, _ = corpus(make, spark, 24)
    model = ppm_language.fit(docs, order=3)
    text = "the thing of the ship " * 50
    whole = model.text_bits([text])
    monkeypatch.setattr(ppm_language, "SEGMENT", 100)
    assert abs(model.text_bits([text]) - whole).max() < 1e-6


def test_awkward_rows(awkward, make):
    out = ppm_language.identify(awkward).collect()
    assert len(out) == 13
    by = {r.doc_id: r for r in out}
    assert all((by[i].lang_pred, by[i].score) == ("und", 0.0) for i in (1, 2, 3, 11))
    assert by[None].held_out and by[10].lang_pred == "en"
    assert ppm_language.identify(make([])).collect() == []


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(0, "text", None)], "doc_id long, text string, lang string")
    assert ppm_language.identify(docs).first().lang_pred == "und"


def test_a_language_of_long_texts_only_is_learned(spark):
    rng = random.Random(8)
    rows = [
        (i, " ".join(rng.choices(WORDS[lang], k=9000 if lang == "de" else 30)), lang)
        for i, lang in enumerate(sorted(WORDS) * 12)
    ]
    assert all(len(t.encode()) > ppm_language.LONGEST for _, t, lang in rows if lang == "de")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    truth = {i: lang for i, _, lang in rows}
    out = ppm_language.identify(docs).collect()
    assert [r.doc_id for r in out if r.lang_pred != truth[r.doc_id]] == []


def test_pieces_are_bounded_and_whole_characters(spark):
    texts = ["über " * 3, "é" * 40, "x" * 25 + "日本" * 9]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [bytes(r[0]) for r in docs.select(ppm_language._piece(docs.text, 25)).collect()]
    assert got[0] == texts[0].encode() and all(len(p) == 25 for p in got[1:])
    assert all(p.decode(errors="ignore") in t for p, t in zip(got, texts, strict=True))
