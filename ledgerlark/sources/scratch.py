"""Shared scratch folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from urllib.parse import unquote, urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Rows of whole texts that a task holds at a time on their way to Python. Workers are used again and keep
# what memory they once took.
BATCH_ROWS = 1000
# A row's number is its file's number times this, plus its place in the file.
FILE_ROWS = 1 << 40


def scratch_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; it is remembered for the
    session. On a cluster a machine-local folder would not be seen by the executors, so a missing
    setting is an error there.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="ledgerlark-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the scratch folder that no other call gets."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the scratch folder and read it back.

    The written table outlives executors, cuts the lineage and can be scanned column by column. With
    ``batch_rows``, tasks that send rows to Python hold at most so many at a time during the write.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(BATCH_CONF)
    try:
        spark.conf.set(BATCH_CONF, batch_rows or before)
        df.write.parquet(path)
    finally:
        spark.conf.set(BATCH_CONF, before)
    return spark.read.schema(df.schema).parquet(path)


def is_stored(docs: DataFrame) -> bool:
    """Whether ``docs`` is a folder of Parquet files, or one file, as it is read without any step after it."""
    if "_metadata" in (c.lower() for c in docs.columns):
        return False
    files = docs.inputFiles()
    paths = {f.rpartition("/")[0] for f in files}
    if len(paths) != 1:
        return False
    # The same plan needs the same path: the files' names are full ones, that of the folder may not be.
    full = [unquote(path) for path in (*paths, *files[:1])]
    for path in (*full, *(urlsplit(path).path for path in full)):
        try:
            read = docs.sparkSession.read.schema(docs.schema).parquet(path)
        except AnalysisException:
            continue
        if docs.sameSemantics(read):
            return True
    return False


def numbered(docs: DataFrame, row_col: str) -> DataFrame:
    """``docs`` with ``row_col``, a long that no two rows share and that a row has on every read.

    Rows of stored Parquet files are numbered by file and place in it, and nothing is written: only the
    files' names pass through the driver. Any other rows are written with their numbers first.
    """
    if not is_stored(docs):
        return materialize(docs.withColumn(row_col, F.monotonically_increasing_id()), "numbered")
    path, file = f"{row_col}_path", f"{row_col}_file"
    while {path.lower(), file.lower()} & {c.lower() for c in docs.columns}:
        path, file = path + "_", file + "_"
    placed = docs.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(row_col))
    paths = sorted(r[0] for r in placed.select(path).distinct().collect())
    files = docs.sparkSession.createDataFrame([(p, i) for i, p in enumerate(paths)], f"{path} string, {file} long")
    row = F.col(file) * F.lit(FILE_ROWS) + F.col(row_col)
    return placed.join(F.broadcast(files), path).select(*docs.columns, row.alias(row_col))
