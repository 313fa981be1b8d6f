"""Quality by ordinal cumulative-link regression on graded ratings.

All grades share one weight vector over hashed text features; ordered thresholds part the grades:
``P(grade <= j) = 1 / (1 + exp(score - threshold_j))``. The model is fitted on a bounded sample of rated
rows; every text is then scored as a whole and gets its expected grade and the probability of its upper
grades.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.shingles import word_hashes
from ledgerlark.sources.scratch import materialize

BITS = 17
SAMPLE = 4000
LONGEST = 16_384
PASSES = 30
RATE = 0.1
DECAY = 1e-4
WORD = re.compile(rb"[a-z\x80-\xff]+")


def _bucket(name: int, value: float) -> int:
    return (name << 8) + min(int(value), 255)


def features(text: str, bits: int = BITS) -> np.ndarray:
    """The sorted hashed features of a text: its words without marks, and its shape in steps."""
    data = text.encode()
    hashes = word_hashes(b" ".join(WORD.findall(data.lower())))
    n = max(1, len(text))
    letters = max(1, sum(map(str.isalpha, text)))
    upper = sum(map(str.isupper, text)) / letters
    words, lines = text.split(), text.splitlines() or [""]
    shape = [
        _bucket(1, 20 * upper), _bucket(2, 20 * letters / n), _bucket(3, np.log2(n)),
        _bucket(4, 10 * len(set(lines)) / len(lines)), _bucket(5, 10 * len(set(words)) / max(1, len(words))),
        _bucket(6, 20 * sum(map(text.count, "|#{}<>*=%$@\\/")) / n * 5), _bucket(7, 20 * text.count("!") / max(1, len(words))),
        _bucket(8, 20 * sum(map(str.isdigit, text)) / n), _bucket(9, n / max(1, len(words))),
    ]
    size = 1 << bits
    words_at = (hashes >> np.uint64(20)) % np.uint64(size - 4096)
    return np.unique(np.concatenate([words_at.astype(np.int64) + 4096, np.array(shape, dtype=np.int64)]))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray
    bits: int

    def score(self, text: str) -> float:
        found = features(text, self.bits)
        return float(self.weights[found].sum())

    def above(self, score: float) -> np.ndarray:
        """``P(grade > j)`` for each threshold ``j``."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - score, -500, 500)))


def fit_rows(rows: list[tuple[np.ndarray, int]], grades: int, bits: int = BITS, passes: int = PASSES,
             rate: float = RATE, decay: float = DECAY, seed: int = 1) -> Model:
    """Thresholds and weights by adaptive gradient steps on batches, in a fixed order."""
    weights, squares = np.zeros(1 << bits), np.full(1 << bits, 1e-2)
    shares = np.bincount([g for _, g in rows], minlength=grades)[:grades] + 1.0
    below = np.cumsum(shares)[:-1] / shares.sum()
    thresholds = np.log(below / (1 - below))
    rng = np.random.default_rng(seed)
    for turn in range(passes):
        step = rate / (1 + turn / 10)
        for start in np.split(rng.permutation(len(rows)), range(32, len(rows), 32)):
            at, slopes = [], []
            cut = np.zeros(grades - 1)
            for i in start:
                found, grade = rows[i]
                s = weights[found].sum()
                upper = 1 / (1 + np.exp(np.clip(thresholds - s, -50, 50)))  # P(grade > j)
                edges = np.concatenate([[1.0], upper, [0.0]])
                # The likelihood's slope by the score is 1 - P(> g) - P(> g - 1) at both edges.
                slope = 1 - edges[grade] - edges[grade + 1]
                share = max(edges[grade] - edges[grade + 1], 1e-9)
                slopes.append(np.full(len(found), slope))
                at.append(found)
                if grade > 0:
                    cut[grade - 1] -= upper[grade - 1] * (1 - upper[grade - 1]) / share
                if grade < grades - 1:
                    cut[grade] += upper[grade] * (1 - upper[grade]) / share
            if not at:
                continue
            index, inverse = np.unique(np.concatenate(at), return_inverse=True)
            grad = np.bincount(inverse, weights=np.concatenate(slopes)) / len(start) - decay * weights[index]
            squares[index] += grad**2
            weights[index] += step * grad / np.sqrt(squares[index])
            thresholds = np.maximum.accumulate(thresholds + step * np.clip(cut / len(start), -1, 1))
            for j in range(1, grades - 1):
                thresholds[j] = max(thresholds[j], thresholds[j - 1] + 1e-3)
    return Model(weights, thresholds, bits)


def fit(docs: DataFrame, ratings: DataFrame, grades: int, id_col: str = "doc_id", text_col: str = "text",
        grade_col: str = "grade", sample: int = SAMPLE, longest: int = LONGEST, bits: int = BITS) -> Model | None:
    """The model of the ``sample`` rated texts that come first by a hash; None when there are none.

    Which texts these are is decided on ids and hashes alone; only their texts, of longer ones a piece of
    ``longest`` bytes from a place given by its hash, come to the driver: ``sample * longest`` bytes at
    most. Ratings without id or grade or outside ``0 .. grades - 1``, and null texts, are not learned from.
    A text that repeats with its id and grade is learned from once.
    """
    rated = ratings.where(F.col(grade_col).between(0, grades - 1)).select(
        F.col(id_col).cast("long").alias("id"), F.col(grade_col).cast("int").alias("grade")
    )
    text = F.col(text_col).cast("string")
    texts = docs.where(text.isNotNull()).select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    hashed = texts.select("id", F.xxhash64("id", "text").alias("h"))
    # Sorting by hash and taking the first keeps a bounded heap of numbers per task.
    first = rated.join(hashed, "id").distinct().orderBy("h", "grade").limit(sample)
    first = materialize(first, "rated")
    # At most ``sample`` rows of three numbers.
    chosen = F.broadcast(first.select("id", "h").distinct())
    found = texts.withColumn("h", F.xxhash64("id", "text")).join(chosen, ["id", "h"], "left_semi")
    places = F.greatest(F.octet_length("text") - F.lit(longest), F.lit(0)) + 1
    start = F.pmod("h", places).cast("int") + 1
    piece = F.substring(F.col("text").cast("binary"), start, F.lit(longest)).alias("piece")
    pieces = {(r.id, r.h): r.piece for r in found.dropDuplicates(["id", "h"]).select("id", "h", piece).collect()}
    rows = [(pieces[r.id, r.h].decode(errors="ignore"), r.grade) for r in first.orderBy("h", "grade").collect()]
    return fit_rows([(features(t, bits), g) for t, g in rows], grades, bits) if rows else None


def _graded(batches, model: Model | None):
    for batch in batches:
        expected, tail = [], []
        for text in batch.column(1):
            if model is None or not text.is_valid or not text.as_py().strip():
                expected.append(0.0)
                tail.append(0.0)
                continue
            above = model.above(model.score(text.as_py()))
            expected.append(float(above.sum()))
            tail.append(float(above[-1]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(expected, pa.float64()), pa.array(tail, pa.float64())],
            names=["id", "expected_grade", "tail"],
        )


def grade(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
          least: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: id, ``expected_grade``, ``tail_probability`` (of the top grade),
    ``selected`` (that it is at least ``least``).

    A text that is null or only white space has grade 0 and is not selected, nor is any text without a
    model. Rows that repeat an id get a row each.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(lambda it: _graded(it, model), "id long, expected_grade double, tail double")
    return out.select(
        F.col("id").alias(id_col), "expected_grade", F.col("tail").alias("tail_probability"),
        (F.col("tail") >= least).alias("selected"),
    )


def ratings_of(labels: DataFrame) -> DataFrame:
    """Grades of the table ``labels``: 0 poor, 1 good but toxic, 2 good."""
    good = F.when(F.col("toxic") == 1, 1).when(F.col("toxic") == 0, 2)
    return labels.select("doc_id", F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, good).alias("grade"))
