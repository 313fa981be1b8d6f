"""Exact BM25 top-k with block-max pruning, per shard, merged with global statistics.

Document counts of terms, the number of documents and their mean length come from the whole corpus, so
a shard's scores need no correction. A shard holds at most about ``shard_bytes`` of text: inverted lists,
the largest contribution of each common term in each block of ``BLOCK`` documents, and the documents'
postings. A query's lists are added up for its rarer terms; terms that are frequent but not common have their
impacts as a matrix, and a batch of queries is multiplied with it at once. A document's bound is that sum and
the weighted maxima of its block for the common terms; blocks are opened for documents whose bound reaches the
k-th best score, and these are scored in full. The queries pass through each shard as a stream, so a task holds one
shard and one batch of queries.

Shards are searched in rounds, each over ``GROW - 1`` times the documents so far. The k-th best score of the
rounds before goes along with a query, so a round returns about ``GROW - 1`` times k rows a query, however
many shards it has.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerlark.llm.shingles import word_hashes
from ledgerlark.sources.scratch import BATCH_ROWS, materialize

K1, B = 1.2, 0.75
BLOCK = 8
# A term in more than this share of a shard's documents is common.
COMMON = 0.2
# Terms in more than this share, fewer than so many, are rows of a matrix of at most so many bytes.
FREQUENT, MOST_FREQUENT, MATRIX_BYTES = 0.01, 1000, 64 << 20
# Queries whose sums are made at once, and the bytes of these sums.
TOGETHER, SUMS_BYTES = 64, 16 << 20
# Up to so many documents are scored one by one, by the query's terms only.
SINGLY = 64
# Documents, times k, that are opened to get a better limit for the others.
FEW = 2
# Sums of up to MOST_FREQUENT rounded terms are made in 32 bits, with an error of 2^-24 a term.
SLACK = 1 + 1e-4
SHARD_BYTES = 64 << 20
# The first round is that part of a shard; after each round at most GROW times as much text is done.
FIRST, GROW = 4, 4
# Queries beyond so many are dealt over several tasks a shard, as long as a round has fewer than WIDE tasks.
SLICE, WIDE = 20_000, 64
PLACES = 1 << 30
CHUNK = 1 << 20
NO_ID = -(1 << 63)


def _terms(text) -> np.ndarray:
    return word_hashes(bytes(text.as_buffer()) if text.is_valid else b"")


def _document_counts(batches):
    """For each batch: how many documents hold each term; and under a null term documents and words."""
    for batch in batches:
        lists = [_terms(t) for t in batch.column(0)]
        found = [np.unique(x) for x in lists]
        terms, counts = np.unique(np.concatenate([*found, np.zeros(0, np.uint64)]), return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([*terms.view(np.int64).tolist(), None], pa.int64()),
                pa.array([*counts.tolist(), len(lists)], pa.int64()),
                pa.array([*([0] * len(terms)), sum(map(len, lists))], pa.int64()),
            ],
            names=["term", "n", "words"],
        )


def _query_terms(batches):
    for batch in batches:
        for key, text in zip(batch.column(0), batch.column(1), strict=True):
            terms, counts = np.unique(_terms(text), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([key.as_py()] * len(terms), pa.int64()), pa.array(terms.view(np.int64)),
                    pa.array(counts.astype(np.int64)),
                ],
                names=["query", "term", "tf"],
            )


def _joined(starts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the lists ``which`` one after the other, and the lists' lengths."""
    lo, n = starts[which], starts[which + 1] - starts[which]
    return np.arange(n.sum()) + np.repeat(lo - np.cumsum(n) + n, n), n


class Shard:
    """The index of one shard's documents."""

    def __init__(self, ids: list[int], lists: list[np.ndarray], mean: float, block: int = BLOCK):
        counted = [np.unique(x, return_counts=True) for x in lists]
        self._build(ids, [x for x, _ in counted], [n for _, n in counted], [len(x) for x in lists], mean, block)

    @classmethod
    def of_counts(
        cls, ids: list[int], terms: list[np.ndarray], counts: list[np.ndarray], lengths: list[int], mean: float
    ) -> Shard:
        """The index of documents given by their sorted distinct terms, how often each has these, and its words.

        The lists of terms and counts are emptied.
        """
        shard = cls.__new__(cls)
        shard._build(ids, terms, counts, lengths, mean, BLOCK)
        return shard

    def _build(self, ids, terms, counts, lengths, mean, block) -> None:
        order = np.argsort(lengths, kind="stable")  # alike lengths make tight bounds
        self.ids = np.array(ids, dtype=np.int64)[order]
        self.block, self.blocks = block, -(-len(ids) // block)
        self.norm = K1 * (1 - B + B * np.array(lengths, dtype=np.int64)[order] / mean)
        sizes = np.array([len(terms[i]) for i in order], dtype=np.int64)
        self.starts = np.append(0, np.cumsum(sizes)).astype(np.int64)
        self.counts = np.concatenate([*(counts[i] for i in order), np.zeros(0, np.int64)], dtype=np.int32, casting="unsafe")
        flat = np.concatenate([*(terms[i] for i in order), np.zeros(0, np.uint64)])
        terms.clear()
        counts.clear()
        # Inverted lists of documents.
        by = np.argsort(flat, kind="stable")
        flat = flat[by]
        new = np.ones(len(flat), dtype=bool)
        new[1:] = flat[1:] != flat[:-1]
        self.vocabulary = flat[new]
        self.list_start = np.append(np.flatnonzero(new), len(flat))
        self.terms = np.empty(len(flat), np.int32)
        self.terms[by] = np.cumsum(new, dtype=np.int32) - 1
        document = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        impact = np.empty(len(flat), np.float32)
        for start in range(0, len(flat), CHUNK):
            part = slice(start, start + CHUNK)
            impact[part] = self._impacts(part, document[part])
        self.list_impact = impact[by]
        self.list_document = document[by]
        del flat, by, new, document, impact
        # Of frequent terms the impact in each document.
        held = np.diff(self.list_start)
        frequent = np.flatnonzero((held > FREQUENT * len(sizes)) & (held <= COMMON * len(sizes)))
        most = min(MOST_FREQUENT, MATRIX_BYTES // (4 * max(1, len(sizes))))
        frequent = frequent[np.argsort(-held[frequent], kind="stable")[:most]]
        self.matrix_row = np.full(len(self.vocabulary), -1, np.int32)
        self.matrix_row[frequent] = np.arange(len(frequent))
        self.matrix = np.zeros((len(frequent), len(sizes)), np.float32)
        for i, term in enumerate(frequent):
            own = slice(self.list_start[term], self.list_start[term + 1])
            self.matrix[i, self.list_document[own]] = self.list_impact[own]
        # Of common terms also the largest in each block.
        common = np.flatnonzero(held > COMMON * len(sizes))
        self.row = np.full(len(self.vocabulary), -1, np.int32)
        self.row[common] = np.arange(len(common))
        self.maxima = np.zeros((len(common), self.blocks), np.float32)
        self.common_impact = np.zeros((len(sizes), len(common)), np.float32)
        for i, term in enumerate(common):
            own = slice(self.list_start[term], self.list_start[term + 1])
            np.maximum.at(self.maxima[i], self.list_document[own] // block, self.list_impact[own])
            self.common_impact[self.list_document[own], i] = self.list_impact[own]
        self.weights = np.zeros(len(self.vocabulary))
        self.opened = 0

    def _impacts(self, postings, document: np.ndarray) -> np.ndarray:
        tf = self.counts[postings]
        return tf * (K1 + 1) / (tf + self.norm[document])

    def _sums(self, at: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For each document the contributions of the terms ``at``."""
        if not len(at):
            return np.zeros(len(self.ids))
        index, n = _joined(self.list_start, at)
        impacts = self.list_impact[index] * np.repeat(weights, n)
        return np.bincount(self.list_document[index], weights=impacts, minlength=len(self.ids))

    def _scores(self, docs: np.ndarray, at: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The scores of ``docs`` by the terms ``at``, which go upwards; either way added in this order."""
        if len(docs) > SINGLY:
            self.weights[at] = weights
            index, size = _joined(self.starts, docs)
            by = self.weights[self.terms[index]]
            self.weights[at] = 0.0
        else:
            found, by, short = [], [], at.astype(np.int32)
            for lo, hi in zip(self.starts[docs].tolist(), self.starts[docs + 1].tolist(), strict=True):
                own = self.terms[lo:hi]
                place = np.searchsorted(own, short)
                place[place == len(own)] = 0
                here = own[place] == short
                found.append(place[here] + lo)
                by.append(weights[here])
            size = np.array([len(x) for x in found], dtype=np.int64)
            index = np.concatenate([*found, np.zeros(0, np.int64)])
            by = np.concatenate([*by, np.zeros(0)])
        impacts = self._impacts(index, np.repeat(docs, size))
        return np.bincount(np.repeat(np.arange(len(docs)), size), weights=by * impacts, minlength=len(docs))

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, least: float = 0.0) -> list[tuple[int, float]]:
        """The ``k`` best documents that share a term and score ``least`` or more: score downwards, then id upwards."""
        return self.search_all([(terms, weights, least)], k)[0]

    def search_all(self, queries: list[tuple[np.ndarray, np.ndarray, float]], k: int) -> list[list[tuple[int, float]]]:
        """:meth:`search` for each of ``queries``: terms, weights, least score."""
        out: list[list[tuple[int, float]]] = [[] for _ in queries]
        if not len(self.vocabulary) or not queries:
            return out
        terms, inverse = np.unique(np.concatenate([q[0] for q in queries]), return_inverse=True)
        place = np.minimum(np.searchsorted(self.vocabulary, terms), len(self.vocabulary) - 1)
        place[self.vocabulary[place] != terms] = -1
        ends = np.cumsum([len(q[0]) for q in queries])[:-1]
        held, known = np.diff(self.list_start), []
        for i, (at, (_, weights, _)) in enumerate(zip(np.split(place[inverse], ends), queries, strict=True)):
            here = np.flatnonzero(at >= 0)
            here = here[np.argsort(at[here], kind="stable")]
            if len(here):
                at = at[here]
                known.append((int(at[np.argmax(held[at])]), i, at, weights[here]))
        # Queries with the same most frequent term are much alike: together they use few rows of the matrix.
        known.sort(key=lambda x: x[:2])
        together = max(1, min(TOGETHER, SUMS_BYTES // (4 * len(self.ids))))
        for start in range(0, len(known), together):
            some = known[start : start + together]
            mixed = np.zeros((len(some), len(self.matrix)), np.float32)
            for j, (_, _, at, weights) in enumerate(some):
                row = self.matrix_row[at]
                mixed[j, row[row >= 0]] = weights[row >= 0]
            used = mixed.any(axis=0)
            few = used.sum() < len(used) / 2  # else a copy of the rows does not pay
            sums = mixed[:, used] @ self.matrix[used] if few else mixed @ self.matrix
            for j, (_, i, at, weights) in enumerate(some):
                out[i] = self._best(at, weights, sums[j], k, queries[i][2])
        return out

    def _best(self, at, weights, sums: np.ndarray, k: int, least: float) -> list[tuple[int, float]]:
        """The best documents for the terms ``at``, which go upwards; ``sums`` are those of frequent terms."""
        # The rarer terms' lists are added up; what the common ones can add is bounded by block.
        common = self.row[at] >= 0
        rare = ~common & (self.matrix_row[at] < 0)
        sums = sums + self._sums(at[rare], weights[rare])
        row, heavy = self.row[at[common]], weights[common].astype(np.float32)
        order = np.argsort(self.list_start[at[common] + 1] - self.list_start[at[common]], kind="stable")
        row, heavy = row[order], heavy[order]
        possible = sums + np.repeat(heavy @ self.maxima[row], self.block)[: len(sums)]

        def limit(sums: np.ndarray) -> float:
            """``least``, or a score that k documents of these sums reach."""
            return max(least, float(np.partition(sums, -k)[-k]) / SLACK) if len(sums) >= k else least

        def added(docs: np.ndarray, sums: np.ndarray, upto: int) -> np.ndarray:
            return sums + self.common_impact[docs[:, None], row[:upto]] @ heavy[:upto]

        if least <= 0:
            least = limit(sums)
        docs = np.flatnonzero((possible >= least / SLACK) & (possible > 0))
        sums, possible = sums[docs], possible[docs]
        while len(docs) > FEW * k and len(row):
            # The likeliest ones give a better limit; for the others half of the common terms are added.
            likely = np.argpartition(sums, -FEW * k)[-FEW * k :]
            least, half = limit(added(docs[likely], sums[likely], len(row))), (len(row) + 1) // 2
            near = possible * SLACK >= least
            docs = docs[near]
            sums = added(docs, sums[near], half)
            row, heavy = row[half:], heavy[half:]
            possible = sums + (heavy @ self.maxima[row])[docs // self.block]
            near = possible * SLACK >= least
            docs, sums, possible = docs[near], sums[near], possible[near]
        self.opened += len(np.unique(docs // self.block))
        sums = added(docs, sums, len(row))
        least = limit(sums)
        docs = docs[sums * SLACK >= least]
        # The few that are left are scored by their own postings.
        got = self._scores(docs, at, weights)
        docs, scores = docs[(got > 0) & (got >= least)], got[(got > 0) & (got >= least)]
        best = np.lexsort((self.ids[docs], -scores))[:k]
        ids, scores = self.ids[docs[best]], scores[best]
        return list(zip(ids.tolist(), scores.tolist(), strict=True))


def _searched(batches, k: int, mean: float):
    """Rows of a shard come documents first, then queries."""
    shard, index, held = None, None, ([], [], [], [])
    asked: list[tuple[int, tuple[np.ndarray, np.ndarray, float]]] = []
    out: list[tuple[int, int, float]] = []

    def answer() -> None:
        for (query, _), found in zip(asked, index.search_all([q for _, q in asked], k) if asked else [], strict=True):
            out.extend((query, i, s) for i, s in found)
        asked.clear()

    for batch in batches:
        out.clear()
        columns = [batch.column(n) for n in ("shard", "id", "text", "terms", "weights", "least")]
        for number, key, text, terms, weights, least in zip(*columns, strict=True):
            if number.as_py() != shard:
                answer()
                shard, index, held = number.as_py(), None, ([], [], [], [])
            if not terms.is_valid:
                words = _terms(text)
                found, counts = np.unique(words, return_counts=True)
                for kept, x in zip(held, (key.as_py(), found, counts.astype(np.int32), len(words)), strict=True):
                    kept.append(x)
                continue
            if index is None:
                index, held = Shard.of_counts(*held, mean), ([], [], [], [])
            wanted = terms.values.to_numpy().view(np.uint64)
            asked.append((key.as_py(), (wanted, weights.values.to_numpy(), least.as_py())))
        answer()
        columns = list(zip(*out, strict=True)) if out else [[], [], []]
        types = [pa.int64(), pa.int64(), pa.float64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["query", "id", "score"]
        )


def _rounds(size: int, shard_bytes: int) -> list[tuple[int, int, int]]:
    """For each round the places its documents have, from and to, and its number of shards."""
    done, ends = max(1, shard_bytes // FIRST), []
    while done < size:
        ends.append(done)
        done *= GROW
    ends.append(max(1, size))
    places = [0, *(end * PLACES // ends[-1] for end in ends)]
    shards = [-(-(b - a) // shard_bytes) for a, b in zip([0, *ends], ends, strict=False)]
    return list(zip(places, places[1:], shards, strict=False))


def top_k(
    docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``doc_id``, ``score``: the ``k`` best of ``docs`` for each row of
    ``queries`` (same column names), its whole text being the query.

    Only documents that share a word are listed, so a null or empty query has none. Ties go to the
    smaller id. A query finds itself if it is among ``docs``. Rows that repeat an id are documents of
    their own; queries that repeat an id are one query with all their words. A null id is an id like
    any other and comes first.
    """
    def plain(df: DataFrame) -> DataFrame:
        return df.select(
            F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
            F.col(text_col).cast("binary").alias("text"),
        )

    texts, asked = plain(docs), plain(queries)
    counted = texts.select("text").mapInArrow(_document_counts, "term long, n long, words long")
    counts = materialize(
        counted.groupBy("term").agg(F.sum("n").alias("n"), F.sum("words").alias("words")), "document_counts"
    )
    whole = counts.where("term IS NULL").first()
    total, words = (whole["n"], whole["words"]) if whole else (0, 0)
    mean = max(1.0, words / max(1, total))
    size = docs.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    idf = F.log(1 + (F.lit(float(total)) - F.col("n") + 0.5) / (F.col("n") + 0.5))
    weighted = (
        asked.mapInArrow(_query_terms, "query long, term long, tf long")
        .groupBy("query", "term").agg(F.sum("tf").alias("tf"))
        .join(counts.where("term IS NOT NULL"), "term")
        .groupBy("query")
        # Common terms come first and in one order, so neighbouring queries compress well.
        .agg(F.sort_array(F.collect_list(F.struct("n", "term", (F.col("tf") * idf).alias("w"))), asc=False).alias("words"))
        .select("query", F.col("words.term").alias("terms"), F.col("words.w").alias("weights"))
    )
    weighted = materialize(weighted, "queries")
    many = -(-weighted.count() // SLICE)
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "id"))
    best = None
    for first, last, shards in _rounds(size, shard_bytes):
        slices = max(1, min(many, WIDE // shards))
        limit = F.lit(0.0).alias("least")
        passed = weighted
        if best is not None:
            kth = best.where(F.col("rank") == k).select("query", F.col("score").alias("kth"))
            passed, limit = weighted.join(kth, "query", "left"), F.coalesce("kth", F.lit(0.0)).alias("least")
        place = F.pmod(F.xxhash64("id", "text"), F.lit(PLACES))
        shard = F.floor((place - first) * shards / F.lit(last - first)).cast("int")
        documents = texts.where((place >= first) & (place < last)).select(
            F.explode(F.sequence(shard * slices, shard * slices + (slices - 1))).alias("shard"),
            F.lit(0).alias("kind"), "id", "text", F.lit(None).cast("array<bigint>").alias("terms"),
            F.lit(None).cast("array<double>").alias("weights"), F.lit(None).cast("double").alias("least"),
        )
        mine = F.pmod(F.xxhash64("query"), F.lit(slices)).cast("int")
        passed = passed.select(
            F.explode(F.sequence(mine, F.lit((shards - 1) * slices) + mine, F.lit(slices))).alias("shard"),
            F.lit(1).alias("kind"), F.col("query").alias("id"), F.lit(None).cast("binary").alias("text"),
            "terms", "weights", limit,
        )
        streams = documents.unionByName(passed).repartitionById(shards * slices, "shard")
        found = streams.sortWithinPartitions("shard", "kind").mapInArrow(
            lambda it: _searched(it, k, mean), "query long, id long, score double"
        )
        if best is not None:
            found = best.drop("rank").unionByName(found)
        best = materialize(found.withColumn("rank", rank).where(F.col("rank") <= k), "best", BATCH_ROWS)
    real = lambda c: F.nullif(F.col(c), F.lit(NO_ID))
    return best.select(real("query").alias("query_id"), "rank", real("id").alias(id_col), "score")
