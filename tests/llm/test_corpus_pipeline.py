from __future__ import annotations

import os
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlark.llm import bbit_minhash, slack_packing, suffix_dedup
from ledgerlark.sources.scratch import BATCH_ROWS, is_stored, materialize, numbered, scratch_path


def stages(spark, docs):
    out = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out.append(stage(spark, out[-1], ""))
    return out[1:]


def test_one_copy_of_repeated_rows_stays(make, spark):
    """Every distinct text of over 100 bytes is in the output once, whatever its ids."""
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) for _ in range(12)]
    rows = [(i if i % 3 else None, t) for i, t in enumerate(texts)]
    spaced = [(7, texts[7].replace(" ", "  "))]
    near = [(20, texts[1] + " more"), (None, texts[3] + " more"), (None, texts[3] + " more")]
    docs = make([*rows, *rows, *rows[:5], *spaced, *near]).repartition(4)
    language, exact, close, last = stages(spark, docs)
    assert language.count() == docs.count() and exact.columns == docs.columns
    want = Counter(texts)
    want[texts[7]], want[spaced[0][1]] = 0, 1
    want[near[0][1]] = want[near[1][1]] = 1
    assert Counter(r.text for r in exact.collect()) == +want
    got = [(r.doc_id, r.text) for r in close.collect()]
    assert len(got) == 12 and (1, texts[1]) in got
    assert sum(t.startswith(texts[3]) for _, t in got) == 1
    kept = [(r.doc_id, r.text) for r in last.collect()]
    assert sorted(kept, key=str) == sorted(got, key=str)


def test_rows_of_one_id_are_decided_each_for_itself(make, spark):
    rng = random.Random(6)
    a, b = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) for _ in range(2))
    docs = make([(1, a), (5, a), (5, b), (2, a + " more"), (2, b)])
    _, exact, close, last = stages(spark, docs)
    assert sorted((r.doc_id, r.text) for r in exact.collect()) == sorted([(1, a), (2, a + " more"), (2, b)])
    want = sorted([(1, a), (2, b)])
    assert sorted((r.doc_id, r.text) for r in close.collect()) == want
    assert sorted((r.doc_id, r.text) for r in last.collect()) == want


def test_without_labels_only_texts_without_letters_go(spark):
    rows = [(1, "some words", None), (None, "other words", None), (None, "12 34", None), (3, None, None), (1, " ", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = corpus_pipeline.language_id(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r.text for r in kept.collect()) == ["other words", "some words"]


def test_a_missing_language_is_filled_in(make, spark):
    words = {"en": "the of and that with", "de": "der und nicht mit auf", "fr": "les des dans pour une"}
    rng = random.Random(7)
    rows = [
        (i, " ".join(rng.choices(words[lang].split(), k=30)), lang if i % 4 else None)
        for i, lang in enumerate(list(words) * 30)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = {i: list(words)[i % 3] for i, *_ in rows}
    assert {r.doc_id: r.lang for r in corpus_pipeline.language_id(spark, docs, "").collect()} == want


NAMES = ("row", "row_", "_row", "_told", "kept", "n_bytes", "n_removed", "n_spans", "k", "r", "dg", "c0", "_c0",
         "id", "ids", "language", "letter", "_lang", "_score", "mark", "recipe", "component_id", "points", "h")


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES[:-1]])
def test_columns_of_any_name_pass_through(make, spark, stage):
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) for _ in range(4)]
    rows = [(1, texts[0]), (2, texts[0]), (3, texts[1] + " more"), (4, texts[1]), (5, None), (6, "9"),
            (7, texts[2] + texts[3]), (8, "a" + texts[3])]
    docs = make(rows)
    plain = {r.doc_id: r.text for r in stage(spark, docs, "").collect()}
    wide = docs.select(*(F.concat(F.lit("x"), F.col("doc_id")).alias(n) for n in NAMES), "*")
    got = stage(spark, wide, "")
    assert got.columns == wide.columns
    found = got.collect()
    assert {r.doc_id: r.text for r in found} == plain
    assert all(r[n] == f"x{r.doc_id}" for r in found for n in NAMES)


def test_empty_table_and_packing_of_what_is_left(make, spark):
    docs = make([])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.collect() == []
    assert corpus_pipeline.packing(spark, docs, "").collect() == []
    some = make([(1, "one two three"), (2, "one two"), (None, "x")])
    packed = corpus_pipeline.packing(spark, some, "").collect()
    assert sorted(r.length for r in packed) == [2, 3, 4] and len({r.sequence_id for r in packed}) == 1


def test_texts_go_to_python_in_small_batches(make, spark, monkeypatch):
    """Workers are used by all stages, so a stage that holds many texts takes memory from the others."""
    seen = {}

    def noted(df, label, batch_rows=None):
        seen[label] = batch_rows
        return materialize(df, label, batch_rows)

    for module in (corpus_pipeline, bbit_minhash, suffix_dedup, slack_packing):
        monkeypatch.setattr(module, "materialize", noted)
    assert corpus_pipeline.run(spark, one_file(make, spark)).count() == 3
    steps = ("languages", "signatures", "shingle_sets", "contexts", "pieces")
    assert {s: seen[s] for s in steps} == dict.fromkeys(steps, BATCH_ROWS)
    # A worker's arrays over texts are cut into segments too.
    tracemalloc.start()
    data = np.random.default_rng(1).integers(97, 123, 3 << 20, dtype=np.uint8)
    suffix_dedup.contexts(data, np.arange(0, len(data) + 1, 2048))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20


def stored_bytes(folder):
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(folder) for f in files)


def test_stages_leave_no_copy_of_stored_texts(make, spark):
    """Scratch tables outlive their stage, so a copy of the texts in each counts against the disk of all."""
    rng = random.Random(9)
    rows = [(i, "".join(rng.choices("abcdefghij klmnopqrstuvwxyz.", k=20_000))) for i in range(60)]
    docs = make([*rows, rows[0], (60, "1 2")]).withColumn("lang", F.when(F.col("doc_id") > 2, F.col("lang")))
    root = spark.conf.get("spark.checkpoint.dir")
    for stage, kept in ((corpus_pipeline.language_id, 61), (corpus_pipeline.exact_dedup, 60)):
        docs = materialize(docs, "input")
        before = stored_bytes(root)
        docs = stage(spark, docs, "")
        assert docs.count() == kept and docs.where("lang is null").isEmpty()
        assert stored_bytes(root) - before < sum(len(t) for _, t in rows) / 4


def test_numbers_of_stored_rows_hold(spark, tmp_path):
    """Also in folders with odd names, in files of many row groups, and below a filter on another column."""
    folder = f"{tmp_path}/a b%20c+d"
    rows = spark.range(0, 50_000, 1, 3).select((F.col("id") % 1000).alias("row_path"), F.col("id").alias("x"))
    rows.write.option("parquet.block.size", 1 << 14).option("parquet.page.size", 1 << 10).parquet(folder)
    docs = spark.read.parquet(folder)
    assert is_stored(docs)
    once = {r.x: r.row for r in numbered(docs, "row").collect()}
    assert len(set(once.values())) == len(once) == 50_000
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        again = numbered(spark.read.parquet(folder), "row").where("x % 7 = 3 and x > 31000 and x < 31900")
        assert {r.x: r.row for r in again.collect()} == {x: n for x, n in once.items() if x % 7 == 3 and 31000 < x < 31900}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert numbered(docs, "row").columns == [*docs.columns, "row"]
    one = [f for f in os.listdir(folder) if f.endswith(".parquet")][0]
    assert is_stored(spark.read.parquet(f"{folder}/{one}"))


def test_other_rows_are_written_with_their_numbers(spark, tmp_path):
    """A step after the scan may repeat rows, so places in files do not tell them apart."""
    spark.range(10).write.parquet(f"{tmp_path}/x/k=1")
    docs = spark.read.parquet(f"{tmp_path}/x/k=1")
    for made in (docs.crossJoin(docs.select("id").toDF("b")), docs.union(docs), docs.withColumn("id", F.explode(F.array("id", "id"))),
                 docs.where("id > 3"), spark.range(5), spark.read.parquet(f"{tmp_path}/x"), docs.withColumnRenamed("id", "_metadata"),
                 spark.read.parquet(f"{tmp_path}/x/k=1", f"{tmp_path}/x/k=1")):
        rows = numbered(made, "row")
        assert not is_stored(made) or made.columns == ["id", "k"]
        got = rows.collect()
        assert len({r.row for r in got}) == len(got) == made.count()
        assert sorted(got) == sorted(rows.collect())


def one_file(make, spark):
    folder = scratch_path(spark, "documents")
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(50))) for i in range(3)]
    make(rows).write.parquet(f"{folder}/documents.parquet")
    return folder
