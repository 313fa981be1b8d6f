"""Language identification by prediction by partial matching.

For each language a model counts which byte follows each context of up to ``order`` bytes. A byte seen
in a context with ``t`` occurrences of ``d`` different bytes costs ``-log2(c / (t + d))`` bits; one not
seen there costs an escape, ``-log2(d / (t + d))``, and is looked up in the next shorter context; below
the empty context all 256 bytes are alike. The language with the shortest code for the whole text wins.

The model is fitted on a bounded sample: per language the ``sample`` texts that come first by a hash, of
a longer text a piece of at most ``longest`` bytes. A task counts one language's sample; what is collected and sent to the tasks
is bounded by the sample. After that the statistics are frozen, and every text is scored as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

ORDER = 4
SAMPLE = 256
LONGEST = 16_384
UNKNOWN = "und"
SEGMENT = 1 << 19
LETTER = re.compile(r"[^\W\d_]")


def _grams(data: np.ndarray, n: int) -> np.ndarray:
    """The last ``n`` bytes up to each position as a number; ``data`` starts with ``ORDER`` or more zeros."""
    out = np.zeros(len(data), dtype=np.uint64)
    for back in range(n):
        part = data[: len(data) - back].astype(np.uint64) << np.uint64(8 * back)
        out[back:] |= part
    return out


def _folded(text: str, order: int) -> bytes:
    return bytes(order) + text.lower().encode()


def _inside(sizes: np.ndarray, order: int) -> np.ndarray:
    """Which bytes of pieces laid end to end are text, not the ``order`` bytes of context before it."""
    out = np.ones(sizes.sum(), dtype=bool)
    begin = np.cumsum(sizes) - sizes
    for back in range(order):
        out[begin + back] = False
    return out


def _piece(text: Column, longest: int) -> Column:
    """A text of at most ``longest`` bytes whole, of a longer one as many from a place given by its hash.

    A character of which only a part lies in the piece is left out.
    """
    data = text.cast("binary")
    places = F.greatest(F.octet_length(text) - F.lit(longest), F.lit(0)) + 1
    start = F.pmod(F.xxhash64(text), places).cast("int") + 1
    return F.when(F.octet_length(text) <= longest, data).otherwise(F.substring(data, start, F.lit(longest)))


def _count(texts: pa.Table, order: int) -> pa.Table:
    """Counts of all runs of 1 to ``order + 1`` bytes of one language's sample."""
    language = texts.column("language")[0].as_py()
    pieces = [_folded(t.decode(errors="ignore"), order) for t in texts.column("piece").to_pylist()]
    data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    inside = _inside(np.array([len(p) for p in pieces]), order)
    parts = []
    for n in range(1, order + 2):
        grams, counts = np.unique(_grams(data, n)[inside], return_counts=True)
        parts.append(
            pa.table({
                "language": pa.array([language] * len(grams), pa.string()),
                "n": pa.array(np.full(len(grams), n, np.int32)),
                "gram": pa.array(grams.view(np.int64)),
                "c": pa.array(counts),
            })
        )
    return pa.concat_tables(parts)


@dataclass(frozen=True)
class Model:
    """Costs in bits, per length of context: rows for byte runs and for contexts, a column per language."""

    order: int
    languages: list[str]
    grams: list[np.ndarray]
    costs: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]

    def text_bits(self, texts: list[str]) -> np.ndarray:
        """The code length of each text in each language."""
        out = np.zeros((len(texts), len(self.languages)))
        buffer, owners, size = [], [], 0
        for i, text in enumerate(texts):
            data = _folded(text, self.order)
            # A segment repeats the bytes before it as context.
            for start in range(self.order, len(data), SEGMENT):
                piece = data[start - self.order : start + SEGMENT]
                if size + len(piece) > SEGMENT and buffer:
                    self._add(buffer, owners, out)
                    buffer, owners, size = [], [], 0
                buffer.append(piece)
                owners.append(i)
                size += len(piece)
        if buffer:
            self._add(buffer, owners, out)
        return out

    def _add(self, pieces: list[bytes], owners: list[int], out: np.ndarray) -> None:
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        sizes = np.array([len(p) for p in pieces])
        wanted = _inside(sizes, self.order)
        owner = np.repeat(np.array(owners), sizes)[wanted]
        # Runs of equal bytes cost the same wherever they stand: look each up once.
        runs, index = np.unique(_grams(data, self.order + 1)[wanted], return_inverse=True)
        bits = self.run_bits(runs)
        for column in range(len(self.languages)):
            out[:, column] += np.bincount(owner, weights=bits[index, column], minlength=len(out))

    def run_bits(self, runs: np.ndarray) -> np.ndarray:
        """The cost of the last byte of each run of ``order + 1`` bytes."""
        bits = np.zeros((len(runs), len(self.languages)))
        open_ = np.arange(len(runs))
        for k in range(self.order, -1, -1):
            gram = runs[open_] & np.uint64((1 << (8 * (k + 1))) - 1)
            at = np.minimum(np.searchsorted(self.grams[k], gram), len(self.grams[k]) - 1)
            seen = self.grams[k][at] == gram
            bits[open_[seen]] += self.costs[k][at[seen]]
            open_, context = open_[~seen], gram[~seen] >> np.uint64(8)
            at = np.minimum(np.searchsorted(self.contexts[k], context), len(self.contexts[k]) - 1)
            known = self.contexts[k][at] == context
            bits[open_[known]] += self.escapes[k][at[known]]
        bits[open_] += 8.0
        return bits


def model_of(rows: list[tuple[str, int, int, int]], order: int) -> Model | None:
    """The model of ``(language, run length, run, count)`` rows; None without any."""
    if not rows:
        return None
    languages = sorted({r[0] for r in rows})
    column = {name: i for i, name in enumerate(languages)}
    language = np.array([column[r[0]] for r in rows])
    lengths, counts = np.array([r[1] for r in rows]), np.array([r[3] for r in rows], dtype=float)
    runs = np.array([r[2] for r in rows], dtype=np.int64).view(np.uint64)
    all_grams, all_costs, all_contexts, all_escapes = [], [], [], []
    for k in range(order + 1):
        mine = lengths == k + 1
        grams, at = np.unique(runs[mine], return_inverse=True)
        c = np.zeros((len(grams), len(languages)))
        c[at, language[mine]] = counts[mine]
        contexts, up = np.unique(grams >> np.uint64(8), return_inverse=True)
        total, kinds = np.zeros((2, len(contexts), len(languages)))
        np.add.at(total, up, c)
        np.add.at(kinds, up, (c > 0).astype(float))
        with np.errstate(divide="ignore", invalid="ignore"):
            # A context that a language has never seen costs nothing to leave.
            escapes = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
            seen = -np.log2(c / (total + kinds)[up])
        if k:
            suffix = grams & np.uint64((1 << (8 * k)) - 1)
            shorter = all_costs[-1][np.searchsorted(all_grams[-1], suffix)]
        else:
            shorter = 8.0
        all_costs.append(np.where(c > 0, seen, escapes[up] + shorter))
        all_grams.append(grams)
        all_contexts.append(contexts)
        all_escapes.append(escapes)
    return Model(order, languages, all_grams, all_costs, all_contexts, all_escapes)


def fit(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", order: int = ORDER,
    sample: int = SAMPLE, longest: int = LONGEST,
) -> Model | None:
    """The model of the rows of ``docs`` that have a text and a language; None when none has.

    Per language at most ``sample`` texts are learned from, and of each at most ``longest`` bytes.
    """
    if not 1 <= order <= 7:
        raise ValueError("order is 1 to 7")
    text, lang = F.col(text_col), F.col(lang_col)
    rows = docs.where(text.isNotNull() & lang.isNotNull())
    # The texts stay behind until the sample is known: a window keeps the first hashes per language.
    hashed = rows.select(lang.alias("language"), F.xxhash64(text).alias("h")).distinct()
    part = F.row_number().over(W.partitionBy("language", F.pmod("h", F.lit(64))).orderBy("h"))
    some = hashed.withColumn("nth", part).where(F.col("nth") <= sample).drop("nth")
    first = F.row_number().over(W.partitionBy("language").orderBy("h"))
    some = some.withColumn("nth", first).where(F.col("nth") <= sample).select("language", "h")
    texts = (
        rows.select(lang.alias("language"), F.xxhash64(text).alias("h"), _piece(text, longest).alias("piece"))
        .join(F.broadcast(some), ["language", "h"], "left_semi")
        .dropDuplicates(["language", "h"])
        .select("language", "piece")
    )
    # A group is one language's sample: at most ``sample * longest`` bytes, whatever the corpus' size.
    counted = texts.groupBy("language").applyInArrow(
        lambda t: _count(t, order), "language string, n int, gram long, c long"
    )
    return model_of([tuple(r) for r in counted.collect()], order)


def _predicted(batches, model: Model | None, carry: Sequence[str]):
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        lettered = [i for i, t in enumerate(texts) if model is not None and LETTER.search(t)]
        if lettered:
            bits = model.text_bits([texts[i] for i in lettered])
            best = bits.argmin(axis=1)
            apart = np.minimum(bits - bits.min(axis=1, keepdims=True), 1000.0)
            share = 1 / np.exp2(-apart).sum(axis=1)
            for i, b, s in zip(lettered, best, share, strict=True):
                names[i], scores[i] = model.languages[b], float(s)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in carry), pa.array(names), pa.array(scores)],
            names=[*carry, "_lang", "_score"],
        )


def _labelled(rows: DataFrame, carry: Sequence[str], model: Model | None) -> DataFrame:
    """The ``carry`` columns of ``rows``, which has a ``text``, with ``_lang`` and ``_score``."""
    fields = [rows.schema[c] for c in carry]
    fields += [T.StructField("_lang", T.StringType()), T.StructField("_score", T.DoubleType())]
    return rows.mapInArrow(lambda it: _predicted(it, model, carry), T.StructType(fields))


def held_out(id_col: str = "doc_id"):
    """Rows kept out of learning: a fourth, by a checksum of the id; rows without an id are in it."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(True))


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    order: int = ORDER, sample: int = SAMPLE, longest: int = LONGEST,
) -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``lang_pred``, ``score``.

    ``score`` is the share of the predicted language when each weighs ``2 ** -bits``. A text that is null
    or has no letter is ``und`` with score 0, as is every text when there is nothing to learn from. On a
    tie the language that is first by name wins. Upper case counts as lower case. Rows that repeat an
    id get a row each. Predictions look at the text alone.
    """
    model = fit(docs.where(~held_out(id_col)), text_col, lang_col, order, sample, longest)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), held_out(id_col).alias("held"), F.col(text_col).alias("text")
    )
    out = _labelled(rows, ["id", "held"], model)
    return out.select(
        F.col("id").alias(id_col), F.col("held").alias("held_out"), F.col("_lang").alias("lang_pred"),
        F.col("_score").alias("score"),
    )


def languages(docs: DataFrame, row_col: str, id_col: str = "doc_id", lang_col: str = "lang") -> DataFrame:
    """Of each row of ``docs`` its ``row_col``, the predicted ``language`` and whether there is a ``letter``.

    Texts without a letter are those that :func:`identify` calls ``und`` when there is a model: null ones
    too. They have no ``language``, and without a model no text has. Each row is decided for itself. Only
    the text goes to Python.
    """
    model = fit(docs.where(~held_out(id_col)), "text", lang_col)

    def predicted(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for column in columns:
            texts = [t or "" for t in column]
            letter = [LETTER.search(t) is not None for t in texts]
            names: list[str | None] = [None] * len(texts)
            lettered = [i for i, has in enumerate(letter) if has and model is not None]
            if lettered:
                best = model.text_bits([texts[i] for i in lettered]).argmin(axis=1)
                for i, b in zip(lettered, best, strict=True):
                    names[i] = model.languages[b]
            yield pd.DataFrame({"language": pd.Series(names, dtype=object), "letter": letter})

    told = F.pandas_udf(predicted, "language string, letter boolean").asNondeterministic()("text").alias("told")
    return docs.select(row_col, told).select(row_col, "told.language", "told.letter")
