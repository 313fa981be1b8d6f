from __future__ import annotations

import random
import zlib
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest

from ledgerlark.llm import streaming_viterbi as sv

PATH = public_tokenizers.path("piece_bpe_32k.model")


def brute(own, marked):
    """The best sum of scores, by the whole table of positions."""
    best = [0.0] + [-float("inf")] * len(marked)
    for end in range(1, len(marked) + 1):
        for n in range(1, min(end, own.longest) + 1):
            piece = marked[end - n : end]
            if piece in own.pieces:
                best[end] = max(best[end], best[end - n] + own.pieces[piece][0])
            elif n == 1:
                best[end] = max(best[end], best[end - 1] + own.missing * len(piece.encode()))
    return best[-1]


def score(own, ids):
    """The sum of scores of ids; bytes of a missing character count as its penalty."""
    return sum(own.missing if i in own.byte_of else own.pieces[own.texts[i]][0] for i in ids)


@pytest.fixture(scope="module")
def own():
    return sv.vocabulary(PATH)


def texts():
    rng = random.Random(2)
    letters = "the ofandingsch  ü߀語\n\t😀"
    return ["".join(rng.choices(letters, k=rng.randrange(1, 80))) for _ in range(150)] + [" ", "a", "   b  "]


def test_score_is_the_best_and_text_comes_back(own):
    for text in texts():
        ids = own.encode(text)
        assert own.decode(ids) == text
        marked = sv.SPACE + text.replace(" ", sv.SPACE)
        assert score(own, ids) == pytest.approx(brute(own, marked))
        assert list(own.search(marked)) == ids


def test_ids_come_before_the_text_ends(own):
    read = 0

    def characters():
        nonlocal read
        for c in "▁the▁ship▁of▁the▁thing" * 200:
            read += 1
            yield c

    stream = own.search(characters())
    next(stream)
    assert read < 200


def test_awkward_rows(awkward, make, own):
    encoded = sv.encode(awkward, PATH)
    back = {r.doc_id: r for r in sv.decode(encoded, PATH).collect()}
    source = {r.doc_id: r.text or "" for r in awkward.collect()}
    assert sv.decode(encoded, PATH).count() == 13
    for i, r in back.items():
        assert r.text == source[i]
        assert r.text_sha256 == sha256(source[i].encode()).hexdigest()
        ids = np.array(own.encode(source[i]), "<u4")
        assert (r.n_ids, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))
    assert sv.encode(make([]), PATH).collect() == []
