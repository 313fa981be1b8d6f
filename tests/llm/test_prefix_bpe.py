"""Prefix BPE against the tokenizers library."""

from __future__ import annotations

import hashlib
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlark.llm import prefix_bpe
from ledgerlark.llm.queries import WORD_TOKENIZER, op12_prefix_bpe

ODD = "abcXYZ019'’.,!_<>|/ \t\n éÉüßÇİıſŉΣσςЖ中文あ한글́̈ﬁ😀\x1c\x85​½²"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_TOKENIZER)


@pytest.fixture(scope="module")
def encoder():
    return prefix_bpe.PrefixEncoder(WORD_TOKENIZER)


def same(encoder, library, text):
    ids, decoded = encoder.round_trip(text.encode())
    want = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == want, repr(text)
    assert decoded.decode() == library.decode(want, skip_special_tokens=False), repr(text)


def random_texts(rng):
    for _ in range(1500):
        yield "".join(rng.choices(ODD, k=rng.randrange(40)))
        yield "".join(rng.choices(rng.choice(["etaoinshrdlu", "abc", "ab!.,", "aé", "aaab"]), k=rng.randrange(60)))
    yield from (letter * n for letter in "aeh!.é" for n in (1, 2, 3, 17, 200, 5000))


def test_equals_the_library(encoder, library):
    for text in random_texts(random.Random(5)):
        same(encoder, library, text)


def test_neighbouring_tokens(encoder, library):
    rng, names = random.Random(6), sorted(library.get_vocab())
    for _ in range(3000):
        same(encoder, library, "".join(rng.choices(names, k=3)).replace("</w>", ""))


def test_names_of_special_tokens_in_a_text(encoder, library):
    for text in ("<|endoftext|>", "a<|endoftext|>b", "x <|startoftext|><|endoftext|> é<|endoftext|>", "<|endoftext"):
        same(encoder, library, text)


def test_small_caches_change_nothing(library):
    small = prefix_bpe.PrefixEncoder(WORD_TOKENIZER, most_known=3)
    for text in random_texts(random.Random(7)):
        same(small, library, text)


def test_slices_are_cut_at_white_space(encoder, library, monkeypatch):
    text = " ".join("".join(random.Random(i).choices("etaoiné", k=i % 30)) for i in range(300))
    monkeypatch.setattr(prefix_bpe, "SLICE", 50)
    same(encoder, library, text + "x" * 500)


def test_rules_in_any_order(tmp_path):
    """A vocabulary whose tokens are made by several rules, also of lower rank than their parts'."""
    with open(WORD_TOKENIZER, encoding="utf-8") as file:
        stored = json.load(file)
    letters = prefix_bpe.byte_letters()
    rng = random.Random(8)
    names = [*letters, *(c + "</w>" for c in letters)]
    some, merges = [*"abc", *(c + "</w>" for c in "abc")], []
    while len(merges) < 60:
        left, right = rng.choice([s for s in some if "</w>" not in s]), rng.choice(some)
        if len(left + right) < 12 and [left, right] not in merges:
            merges.append([left, right])
            some.append(left + right)
    rng.shuffle(merges)
    names += sorted({"".join(m) for m in merges})
    stored["model"] |= {"vocab": {n: i for i, n in enumerate(names)}, "merges": merges}
    stored["added_tokens"] = []
    path = str(tmp_path / "odd.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(stored, file)
    library, encoder = Tokenizer.from_file(path), prefix_bpe.PrefixEncoder(path)
    assert not encoder.regular
    for _ in range(3000):
        same(encoder, library, "".join(rng.choices("abc ", k=rng.randrange(25))))


def test_other_kinds_of_vocabulary_are_refused():
    import public_tokenizers

    with pytest.raises((ValueError, KeyError)):
        prefix_bpe.PrefixEncoder(public_tokenizers.path("byte_bpe_50k.json"))


def test_awkward_rows_and_columns(awkward, library):
    wide = awkward.withColumn("ids", F.lit(1)).withColumn("id", F.lit("x")).withColumn("decoded", F.lit("y"))
    coded = prefix_bpe.encode(wide, WORD_TOKENIZER)
    got = sorted(((r.doc_id, bytes(r.ids), r.decoded) for r in coded.collect()), key=repr)
    want = []
    for r in awkward.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want, key=repr)
    back = prefix_bpe.decode(coded, WORD_TOKENIZER).collect()
    assert sorted((r.doc_id, r.decoded) for r in back if r.doc_id) == sorted((w[0], w[2]) for w in want if w[0])
    assert prefix_bpe.encode(awkward.limit(0), WORD_TOKENIZER).collect() == []


def test_query_over_the_whole_table(spark, library):
    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[1:] for r in op12_prefix_bpe(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        data = np.array(ids, "<u4").tobytes()
        text = library.decode(ids, skip_special_tokens=False)
        digests = hashlib.sha256(data).hexdigest(), hashlib.sha256(text.encode()).hexdigest()
        assert got[r.doc_id] == (len(ids), *digests)


def test_library_pieces_equal_the_library(library):
    made = prefix_bpe.LibraryEncoder(WORD_TOKENIZER, most_known=50)
    for text in [*random_texts(random.Random(8)), "a<|endoftext|>b", "<|endoftext", "", " \n"]:
        assert made.ids(text.encode()).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
