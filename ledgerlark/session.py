"""Session settings the engine's plans benefit from. The caller owns the session and may override."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings only, so they can be applied to a running session.
RECOMMENDED = {
    # Wide projections compile to methods above 8000 bytes of bytecode, which the JVM interprets
    # instead of compiling. With this limit such a stage falls back to many small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Re-planning at run time: joins by measured size, skewed shuffle partitions split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Member ids are random hex digits, which the default codec stores at full length.
    "spark.sql.parquet.compression.codec": "zstd",
}

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SCAN_BYTES = "spark.sql.files.maxPartitionBytes"
TARGET_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
MB = 1024 * 1024
# Map tasks times shuffle partitions is the number of shuffle blocks: both are kept in bounds.
MOST_PARTITIONS = 20_000
MOST_SCAN_TASKS = 100_000


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Size of files or folders, asked of their file system."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = (jvm.org.apache.hadoop.fs.Path(p) for p in paths)
    return sum(p.getFileSystem(conf).getContentSummary(p).getLength() for p in found)


def shuffle_partitions(input_bytes: int, current: int) -> int:
    """Partitions a shuffle starts with, one per 128 MB; small ones are merged again at run time."""
    return max(current, min(MOST_PARTITIONS, -(-input_bytes // (128 * MB))))


def _between(low: int, value: int, high: int) -> int:
    return max(low, min(value, high))


def sized(input_bytes: int, current_partitions: int) -> dict[str, str]:
    """Settings that grow with the input; at or below Spark's defaults they are left out."""
    settings = {}
    partitions = shuffle_partitions(input_bytes, current_partitions)
    if partitions > current_partitions:
        settings[INITIAL_PARTITIONS] = str(partitions)
    per_task = input_bytes // MOST_SCAN_TASKS
    if per_task > 128 * MB:
        settings[SCAN_BYTES] = str(_between(128 * MB, per_task, 1024 * MB))
    if per_task > 64 * MB:
        settings[TARGET_BYTES] = str(_between(64 * MB, per_task, 256 * MB))
    return settings


def tune(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply the recommended settings, with ``input_bytes`` also those that follow from its size.

    Settings that an earlier, larger input had raised are taken back.
    """
    settings = dict(RECOMMENDED)
    if input_bytes is not None:
        for name in (INITIAL_PARTITIONS, SCAN_BYTES, TARGET_BYTES):
            spark.conf.unset(name)
        settings |= sized(input_bytes, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for name, value in settings.items():
        spark.conf.set(name, value)
    return spark
