"""SentencePiece encoding by a streaming Viterbi search, and decoding.

The pieces and their scores are read from a given SentencePiece vocabulary; nothing is trained and texts
are not normalised. A text's best segmentation has the largest sum of scores. The search goes through the text
once and keeps the last ``longest piece`` positions only: a boundary that all surviving backpointer
paths pass through is final, and the ids up to it are given out at once. Where no piece reaches over the
end of a word, every word's end is such a boundary, and words that were met before are not searched again. A
character that no piece
covers becomes its UTF-8 bytes' pieces, or the unknown piece where the vocabulary has no bytes.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import cache
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
WORD = re.compile(f"{SPACE}+[^{SPACE}]*")


def unit(others: str = "") -> re.Pattern[str]:
    """Letters or other characters with the marks before them; ``others`` do not count as letters."""
    more = re.escape(others)
    return re.compile(rf"{SPACE}*(?:[^\W\d_{more}]+|(?:[^\w{SPACE}]|[\d_{more}])+)|{SPACE}+")

# A character without a piece scores this much less than the worst piece, per byte.
PENALTY = 10.0
SOFT_BYTES = 1 << 22
# Words up to this length are searched as a whole and kept, up to a number of them.
SHORT = 64
MOST_KNOWN = 300_000


class Vocabulary:
    """Normal pieces with scores, the pieces of single bytes, and the unknown piece."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in ids]
        self.texts = [model.id_to_piece(i) for i in ids]
        self.unknown = model.unk_id()
        self.bytes = {int(self.texts[i][1:-1], 16): i for i in ids if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.control = {i for i in ids if special[i]}
        self.pieces: dict[str, tuple[float, int]] = {}
        for i in ids:
            if not special[i] and not model.is_byte(i):
                self.pieces[self.texts[i]] = (model.get_score(i), i)
        self.longest = max(map(len, self.pieces), default=1)
        self.missing = min((s for s, _ in self.pieces.values()), default=0.0) - PENALTY
        # Lengths that occur, by first character: most positions try a few lengths only.
        lengths: dict[str, set[int]] = {}
        for piece in self.pieces:
            lengths.setdefault(piece[0], set()).add(len(piece))
        self.lengths = {c: sorted(n) for c, n in lengths.items()}
        # A space mark after another character would tie words together.
        self.words_part = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.pieces)
        self.matches = ahocorasick.Automaton()
        for piece, (score, i) in self.pieces.items():
            self.matches.add_word(piece, (len(piece), score, i))
        if self.pieces:
            self.matches.make_automaton()
        self.known: dict[str, tuple[bytes, int]] = {}
        self.single = {p for p in self.pieces if len(p) == 1}
        # Where no piece has a letter beside another character, paths also meet between these.
        letter = re.compile(r"[^\W\d_]")
        mixed = {c for p in self.pieces if not unit().fullmatch(p) for c in letter.findall(p)}
        parts = unit("".join(sorted(mixed)))
        self.unit = parts if self.words_part and all(map(parts.fullmatch, self.pieces)) else WORD
        texts = [b"" if i in self.control else t.replace(SPACE, " ").encode() for i, t in enumerate(self.texts)]
        self.said = [bytes([self.byte_of[i]]) if i in self.byte_of else t for i, t in enumerate(texts)]

    def fallback(self, character: str) -> list[int]:
        if not self.bytes:
            return [self.unknown]
        return [self.bytes[b] for b in character.encode()]

    def search_word(self, word: str) -> list[int]:
        """The ids of :meth:`search` for a word that is short enough to be kept whole.

        All paths meet at the word's end, so the window is the word. Pieces are found by their ends, longest
        first, in one walk.
        """
        best: list[float | None] = [0.0] + [None] * len(word)
        back = [(0, -1)] * (len(word) + 1)
        if not self.single.issuperset(word):
            return list(self.search(word))
        for at, (length, score, piece) in self.matches.iter(word):
            end = at + 1
            reach = best[end - length] + score
            had = best[end]
            if had is None or reach > had:
                best[end], back[end] = reach, (end - length, piece)
        path, end = [], len(word)
        while end:
            end, piece = back[end]
            path.append(piece)
        path.reverse()
        return path

    def _word(self, word: str) -> tuple[bytes, int]:
        """A word's ids as little-endian 32-bit numbers, and how many."""
        short = len(word) <= SHORT
        ids = self.search_word(word) if short else list(self.search(word))
        made = array("I", ids).tobytes(), len(ids)
        if short:
            if len(self.known) >= MOST_KNOWN:
                self.known.clear()
            self.known[word] = made
        return made

    def search(self, characters: Iterable[str]) -> Iterator[int]:
        """The ids of the best segmentation, given out as soon as they are settled.

        Of segmentations with equal scores the one whose last piece is longest wins, from the end on.
        """
        window, scores, back = "", [0.0], [(0, -1)]  # of each boundary since the last settled one
        open_: list[tuple[float, int, int] | None] = []  # best arrival at the boundaries ahead
        ahead = ""

        def settled(upto: int) -> list[tuple[int, int, int]]:
            path = []
            while upto > 0:
                start, piece = back[upto]
                path.append((start, upto, piece))
                upto = start
            return path[::-1]

        def given(path):
            for start, end, piece in path:
                if piece >= 0:
                    yield piece
                else:
                    yield from self.fallback(window[start:end])

        source, done = iter(characters), False
        while True:
            while not done and len(ahead) < self.longest:
                one = next(source, None)
                if one is None:
                    done = True
                else:
                    ahead += one
            if not ahead:
                yield from given(settled(len(window)))
                return
            here, score = len(window), scores[-1]
            for n in (1, *(k for k in self.lengths.get(ahead[0], ()) if k > 1)):
                if n > len(ahead):
                    break
                found = self.pieces.get(ahead[:n])
                if found is None:
                    if n > 1:
                        continue
                    found = (self.missing * len(ahead[0].encode()), -1)
                while len(open_) < n:
                    open_.append(None)
                reach = score + found[0]
                if open_[n - 1] is None or reach > open_[n - 1][0]:
                    open_[n - 1] = (reach, here, found[1])
            window += ahead[0]
            ahead = ahead[1:]
            best = open_.pop(0)
            scores.append(best[0])
            back.append((best[1], best[2]))
            # The paths that are still alive start from this boundary or arrive at one ahead.
            alive = {here + 1, *(o[1] for o in open_ if o is not None)}
            while len(alive) > 1:
                latest = max(alive)
                alive.remove(latest)
                alive.add(back[latest][0])
            common = alive.pop()
            if common > 0:
                yield from given(settled(common))
                window, base = window[common:], scores[common]
                scores = [s - base for s in scores[common:]]
                back = [(0, -1), *((s - common, p) for s, p in back[common + 1 :])]
                open_ = [o and (o[0] - base, o[1] - common, o[2]) for o in open_]

    def encode(self, text: str) -> list[int]:
        """The ids of a text, a space mark before it and for each of its spaces."""
        return self.encode_array(text).tolist()

    def encode_array(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype=np.int32)
        marked = SPACE + text.replace(" ", SPACE)
        if not self.words_part:
            return np.fromiter(self.search(marked), dtype=np.int32)
        # No piece reaches from a word into the marks after it, so all paths meet there.
        known = self.known.get
        made = [known(word) or self._word(word) for word in self.unit.findall(marked)]
        return np.frombuffer(b"".join([m[0] for m in made]), dtype="<i4")

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; bytes that are not UTF-8 become replacement characters."""
        return b"".join(map(self.said.__getitem__, ids)).decode(errors="replace").removeprefix(" ")


@cache
def vocabulary(path: str) -> Vocabulary:
    """Read once per Python worker."""
    return Vocabulary(path)


def _encoded(batches, path: str):
    own = vocabulary(path)
    for batch in batches:
        texts, part, size = batch.column(1), [], 0
        start = 0
        for i, text in enumerate(texts):
            ids = own.encode_array(text.as_py() or "")
            part.append(ids)
            size += 4 * len(ids)
            if size >= SOFT_BYTES or i == len(texts) - 1:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(part)), pa.array(part, pa.list_(pa.int32()))],
                    names=["id", "ids"],
                )
                start, part, size = i + 1, [], 0


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id and ``ids``. A null or empty text has no ids.

    Text is taken as it is, but that a space and the space mark are the same. Rows that repeat an id
    get a row each; other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(lambda it: _encoded(it, path), "id long, ids array<int>")
    return out.withColumnRenamed("id", id_col)


def _decoded(batches, path: str):
    own = vocabulary(path)
    for batch in batches:
        for start in range(0, len(batch), 256):
            part = batch.slice(start, 256)
            ids = [i.values.to_numpy() if i.is_valid else None for i in part.column("ids")]
            texts = [None if i is None else own.decode(i.tolist()) for i in ids]
            sums = [0 if i is None else zlib.crc32(i.astype("<u4").tobytes()) for i in ids]
            counts = [0 if i is None else len(i) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"), pa.array(texts, pa.string()), pa.array(counts, pa.int64()),
                    pa.array(sums, pa.int64()),
                    pa.array([None if t is None else sha256(t.encode()).hexdigest() for t in texts], pa.string()),
                ],
                names=["id", "text", "n_ids", "ids_crc32", "text_sha256"],
            )


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row of ``encoded``: id, ``text``, ``n_ids``, ``ids_crc32``, ``text_sha256``.

    Null ids have a null text. Control and unknown pieces have no text.
    """
    rows = encoded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids"))
    out = rows.mapInArrow(
        lambda it: _decoded(it, path),
        "id long, text string, n_ids long, ids_crc32 long, text_sha256 string",
    )
    return out.withColumnRenamed("id", id_col)
