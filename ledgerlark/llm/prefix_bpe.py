"""Exact BPE ids by dynamic programming over prefixes, and decoding.

Every prefix of a piece has one encoding, and an encoding without its last token is that of the shorter
prefix. So one token is stored per prefix: its last one. Candidates are the vocabulary's tokens that end
at the prefix's end, which an automaton over all tokens with links to the longest known suffix gives in
one walk. A candidate is the last token if it stays apart from the token stored for the prefix before it,
that is, if the merge rules turn the two tokens' letters, joined, into just these two tokens. The ids are
read off backwards. Nothing depends on the order in which merges of a long text would be applied.

The test walks up the two tokens' inner edges: a merge across them happens if its rank comes before the
ranks that make these edges grow. That holds where every token is made by one rule, after its parts;
for other vocabularies the rules are applied to the joined letters.

Texts are cut at ASCII white space, which no piece crosses. A task keeps the results of the pieces it has
met, up to a bound.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_KNOWN = 200_000
LONGEST_KNOWN = 100
SLICE = 1 << 20
FLUSH = 8 << 20
SPACE = b" \t\n\r\x0b\x0c"
# A piece's last letter is a symbol of its own where the vocabulary marks the ends of words.
LAST = 0xF0000
START = -1
# Fixed values of the vocabulary's format: letters that stand for themselves, and the piece pattern.
SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# ASCII white space; characters that stay single ones when normalised; letters of these in lower case.
GAP = r" \t\n\r\x0b\x0c"
USUAL = r"\x21-\x7eÀ-ÖØ-öø-įĲ-ſ"
LOWER = r"a-zß-öø-ſ"
# A word with any other character; the piece pattern for words without one.
UNUSUAL_WORD = rf"(?<![^{GAP}])[{USUAL}]*+[^{GAP}{USUAL}][^{GAP}]*+"
USUAL_PIECE = rf"'s|'t|'re|'ve|'m|'ll|'d|[{LOWER}]+|[0-9]|[^{GAP}{LOWER}0-9]+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte."""
    others = iter(range(256, 512))
    return [chr(b) if b in SHOWN else chr(next(others)) for b in range(256)]


class PrefixEncoder:
    """Encoder and decoder of the byte-level vocabulary with word ends stored at ``path``.

    ``texts=False`` leaves the decoded texts out.
    """

    def __init__(self, path: str, most_known: int = MOST_KNOWN, texts: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        model = stored["model"]
        last = model.get("end_of_word_suffix") or ""
        cutters = (stored.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        if (
            model["type"] != "BPE" or not last or stored.get("decoder") or model.get("dropout")
            or model.get("ignore_merges") or model.get("continuing_subword_prefix")
            or cutters[0].get("pattern") != {"Regex": PATTERN} or cutters[-1].get("type") != "ByteLevel"
            or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in stored["added_tokens"])
        ):
            raise ValueError(f"unsupported kind of vocabulary: {path}")

        self.letters = byte_letters()
        self._learn(path, model, last)

        names = {i: t for t, i in model["vocab"].items()}
        self.added = {t["content"]: t["id"] for t in stored["added_tokens"]}
        names |= {i: t for t, i in self.added.items()}
        self.names = [f"{names[i]} ".encode() if i in names else b"" for i in range(max(names) + 1)]

        tokenizer = Tokenizer.from_file(path)
        self.normalizer, self.cutter, self.model = tokenizer.normalizer, tokenizer.pre_tokenizer, tokenizer.model
        self.unusual, self.piece = re.compile(UNUSUAL_WORD), re.compile(USUAL_PIECE)
        longest_first = sorted(self.added, key=len, reverse=True)
        self.added_pattern = re.compile("|".join(map(re.escape, longest_first)) or r"(?!)")
        self.most_known, self.texts = most_known, texts
        self.pieces: dict[str, tuple[bytes, bytes]] = {}

    def _learn(self, path: str, model: dict, last: str) -> None:
        """Symbols, merge rules and the automaton over all tokens."""
        import ahocorasick

        vocabulary: dict[str, int] = model["vocab"]
        self.symbols: dict[int, str] = {}
        for letter in self.letters:
            self.symbols[vocabulary[letter]] = letter
            self.symbols[vocabulary[letter + last]] = chr(LAST + ord(letter))
        self.single = {s: i for i, s in self.symbols.items()}
        self.rules: dict[tuple[int, int], tuple[int, int]] = {}
        self.made_by: dict[int, tuple[int, int, int]] = {}
        # Whether each token is made by one rule, of a higher rank than the rules that make its parts.
        self.regular = True
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, made = vocabulary[left], vocabulary[right], vocabulary[left + right]
            self.regular &= made not in self.made_by
            self.rules[a, b] = rank, made
            self.made_by[made] = rank, a, b
            for name in (left, right, left + right):
                text = name.removesuffix(last)
                ending = chr(LAST + ord(text[-1])) if text and text != name else text[-1:]
                self.symbols[vocabulary[name]] = text[:-1] + ending
        for a, b in self.rules:
            if self.symbols[a] + self.symbols[b] != self.symbols[self.rules[a, b][1]]:
                raise ValueError(f"a rule of {path} joins other letters than its token's")
        parts = ((rank, part) for rank, *pair in self.made_by.values() for part in pair)
        self.regular &= all(part not in self.made_by or self.made_by[part][0] < rank for rank, part in parts)

        self.matches = ahocorasick.Automaton()
        for token, symbols in self.symbols.items():
            # With what is known of the tokens it may follow.
            self.matches.add_word(symbols, (token, len(symbols), {}))
        self.matches.make_automaton()
        self.edges: dict[tuple[int, int], list[tuple[int, float]]] = {}
        self.whole: dict[int, bool] = {}

    def _merged(self, symbols: str) -> list[int]:
        """What the merge rules make of a short sequence: the lowest rank first, of equals the leftmost."""
        tokens = [self.single[s] for s in symbols]
        while len(tokens) > 1:
            found = [
                (*rule, at)
                for at, pair in enumerate(zip(tokens, tokens[1:], strict=False))
                if (rule := self.rules.get(pair)) is not None
            ]
            if not found:
                break
            _, made, at = min(found, key=lambda f: (f[0], f[2]))
            tokens[at : at + 2] = [made]
        return tokens

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The pieces at a token's left (1) or right (2) edge while it is made, and the rank that ends each."""
        known = self.edges.get((token, side))
        if known is None:
            known, until, piece = [], float("inf"), token
            while True:
                known.append((piece, until))
                rule = self.made_by.get(piece)
                if rule is None:
                    break
                until, piece = rule[0], rule[side]
            self.edges[token, side] = known
        return known

    def _is_whole(self, token: int) -> bool:
        """Whether the rules make the token out of its own letters."""
        known = self.whole.get(token)
        if known is None:
            known = self.whole[token] = self._merged(self.symbols[token]) == [token]
        return known

    def _stay_apart(self, before: int, token: int) -> bool:
        if before == START or not self._is_whole(token):
            return self._is_whole(token)
        if not self.regular:
            return self._merged(self.symbols[before] + self.symbols[token]) == [before, token]
        rules, inner = self.rules, self._edge(token, 1)
        for left, left_until in self._edge(before, 2):
            for right, right_until in inner:
                rule = rules.get((left, right))
                # Of equal ranks the merge further left comes first.
                if rule is not None and rule[0] < left_until and rule[0] <= right_until:
                    return False
        return True

    def encode_piece(self, letters: str) -> list[int]:
        """Ids of one piece, given in byte letters."""
        symbols = letters[:-1] + chr(LAST + ord(letters[-1]))
        last: list[int | None] = [START] + [None] * len(symbols)
        size = [0] * (len(symbols) + 1)
        for at, (token, length, after) in self.matches.iter(symbols):
            end = at + 1
            if last[end] is None:
                before = last[end - length]
                fits = after.get(before)
                if fits is None:
                    if len(after) >= self.most_known:
                        after.clear()
                    fits = after[before] = self._stay_apart(before, token)
                if fits:
                    last[end], size[end] = token, length
        ids, end = [], len(symbols)
        while end:
            ids.append(last[end])
            end -= size[end]
        ids.reverse()
        return ids

    def decode_ids(self, ids: np.ndarray | list[int]) -> bytes:
        """UTF-8 names of the ids, each followed by a blank; ids outside the vocabulary give nothing."""
        most = len(self.names)
        return b"".join([self.names[i] for i in ids if i < most])

    def _result(self, ids: list[int]) -> tuple[bytes, bytes]:
        return array("I", ids).tobytes(), self.decode_ids(ids) if self.texts else b""

    def _piece(self, piece: str) -> tuple[bytes, bytes]:
        """Result of a piece as it stands in a text."""
        letters = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
        made = self._result(self.encode_piece(letters))
        if len(piece) <= LONGEST_KNOWN:
            if len(self.pieces) >= self.most_known:
                self.pieces.clear()
            self.pieces[piece] = made
        return made

    def _usual(self, text: str) -> list[tuple[bytes, bytes]]:
        known = self.pieces.get
        return [known(piece) or self._piece(piece) for piece in self.piece.findall(text.lower())]

    def _any(self, text: str) -> list[tuple[bytes, bytes]]:
        """Results of a text without names of special tokens."""
        made, start = [], 0
        for word in self.unusual.finditer(text):
            made += self._usual(text[start : word.start()])
            for piece, _ in self.cutter.pre_tokenize_str(self.normalizer.normalize_str(word.group())):
                if piece:
                    made.append(self._result(self.encode_piece(piece)))
            start = word.end()
        return made + self._usual(text[start:])

    def _slice(self, text: str) -> list[tuple[bytes, bytes]]:
        made, start = [], 0
        for name in self.added_pattern.finditer(text):
            made += self._any(text[start : name.start()])
            made.append(self._result([self.added[name.group()]]))
            start = name.end()
        return made + self._any(text[start:])

    def round_trip(self, data: bytes) -> tuple[bytes, bytes]:
        """Ids of a UTF-8 text as little-endian 32-bit numbers, and the UTF-8 text they decode to."""
        ids, texts, start = [], [], 0
        while start < len(data):
            end = start + SLICE
            while end < len(data) and data[end] not in SPACE:
                end += 1
            made = self._slice(data[start:end].decode(errors="replace"))
            ids.append(b"".join([m[0] for m in made]))
            if self.texts:
                texts.append(b"".join([m[1] for m in made]))
            start = end
        return b"".join(ids), b"".join(texts)[:-1]


    def ids(self, data: bytes) -> np.ndarray:
        """Ids of a UTF-8 text."""
        return np.frombuffer(self.round_trip(data)[0], dtype="<u4")


class _Known(dict):
    """Ids of pieces, made when first asked for; emptied when full."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        self.make, self.most = make, most

    def __missing__(self, piece: str) -> bytes:
        made = self.make(piece)
        if len(piece) <= LONGEST_KNOWN:
            if len(self) >= self.most:
                self.clear()
            self[piece] = made
        return made


class LibraryEncoder(PrefixEncoder):
    """The same cutting into pieces, with each piece's ids from the library's own model; no decoded texts."""

    def __init__(self, path: str, most_known: int = MOST_KNOWN):
        super().__init__(path, most_known, texts=False)
        self.odd = re.compile(f"[^{GAP}{USUAL}]")
        self.known = _Known(lambda piece: self._piece(piece)[0], most_known)

    def _learn(self, path: str, model: dict, last: str) -> None:
        """Nothing: the library knows the merge rules."""

    def encode_piece(self, letters: str) -> list[int]:
        """Ids of one piece, given in byte letters."""
        return [token.id for token in self.model.tokenize(letters)]

    def _piece(self, piece: str) -> tuple[bytes, bytes]:
        letters = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
        return self._result(self.encode_piece(letters))

    def _usual(self, text: str) -> list[tuple[bytes, bytes]]:
        return [(b"".join(map(self.known.__getitem__, self.piece.findall(text.lower()))), b"")]

    def _any(self, text: str) -> list[tuple[bytes, bytes]]:
        return super()._any(text) if self.odd.search(text) else self._usual(text)


_ENCODERS: dict[tuple[str, type[PrefixEncoder]], PrefixEncoder] = {}


def encoder(path: str, kind: type[PrefixEncoder] = PrefixEncoder) -> PrefixEncoder:
    """The worker's encoder; another one takes the place of the last. The library's makes ids only."""
    if (path, kind) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, kind] = kind(path)
    return _ENCODERS[path, kind]


def _flushed(rows: Iterator[tuple], types: list[pa.DataType], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows as batches of a bounded number of bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(v) for v in row[1:] if v is not None)
        if size >= FLUSH:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names
            )
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names
        )


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for key, value in zip(batch.column(0), batch.column(1), strict=True):
            yield key.as_py(), value.as_py() or b""


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded`` (string).

    ``ids`` are those the tokenizers library gives for the vocabulary file at ``path`` without added
    special tokens, truncation and padding; names of special tokens in a text are these tokens.
    ``decoded`` is the ids' names joined by blanks, special ones included. Whole texts are encoded, in
    slices cut at white space; a null or empty text has no ids and an empty ``decoded``. Repeated and
    null document ids stay rows of their own. Other columns are not looked at. An empty table gives an
    empty one. ``path`` must be readable on every executor.
    """
    texts = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trip = encoder(path).round_trip
        rows = ((key, *trip(data)) for key, data in _rows(batches))
        return _flushed(rows, [pa.int64(), pa.binary(), pa.string()], ["id", "ids", "decoded"])

    return texts.mapInArrow(work, "id long, ids binary, decoded string").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """Per row of :func:`encode`'s kind: id and ``decoded``, from ``ids`` alone; null counts as no ids."""
    rows = encoded.select(F.col(id_col).cast("long").alias("id"), "ids")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = encoder(path).decode_ids
        rows = ((key, text(np.frombuffer(data, "<u4").tolist())[:-1]) for key, data in _rows(batches))
        return _flushed(rows, [pa.int64(), pa.string()], ["id", "decoded"])

    return rows.mapInArrow(work, "id long, decoded string").withColumnRenamed("id", id_col)
