"""Small document tables with the awkward cases every operator has to bear."""

from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make(spark):
    """A table of (id, text) rows; other columns are filled in."""

    def made(rows):
        full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)

    return made


@pytest.fixture
def awkward(make):
    """Null id, null and empty text, repeated rows and ids, ties, a long text."""
    word = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    long = " ".join(f"w{i}" for i in range(30_000))
    return make(
        [(None, word), (1, None), (2, ""), (3, "   \n"), (4, word), (4, word), (5, word), (6, long),
         (7, long + " end"), (8, "one two"), (9, "ONE  two"), (10, "é"), (11, None)]
    )
