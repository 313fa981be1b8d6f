"""Files of the partitioned loans can be skipped by member and by status."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerlark.sources import writers
from ledgerlark.sources.clustering import interleaved_key
from small_tables import rows


def ranges(folder, column):
    """Minimum and maximum of a column in every file, from the footers a scan reads."""
    out = []
    for path in glob.glob(f"{folder}/**/part-*.parquet", recursive=True):
        meta = pq.ParquetFile(path).metadata
        at = meta.schema.to_arrow_schema().names.index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        out.append((min(s.min for s in stats), max(s.max for s in stats)))
    return out


def test_both_filters_skip_files(spark, tmp_path):
    statuses = ["Charged Off", "Current", "Default", "Fully Paid", "In Grace Period", "Late"]
    data = spark.range(6000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("member_id"), F.col("id").cast("string").alias("loan_id"),
        F.element_at(F.array(*map(F.lit, statuses)), (F.col("id") % 6 + 1).cast("int")).alias("loan_status"),
        F.lit("Jan-2018").alias("issue_date"),
    )
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "36"}
    before = {n: spark.conf.get(n, None) for n in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        writers.write_partitioned(data, "loans_near", path=str(tmp_path / "loans"))
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert rows(spark.table("loans_near").drop("issue_year")) == rows(data)
    members = ranges(tmp_path / "loans", "member_id")
    assert len(members) > 20
    member = data.first().member_id
    of_member = sum(low <= member <= high for low, high in members)
    of_status = sum(low <= "Default" <= high for low, high in ranges(tmp_path / "loans", "loan_status"))
    assert of_member <= len(members) / 2 and of_status <= len(members) / 2


def test_codes_keep_the_order_of_each_column(spark):
    df = spark.createDataFrame([(c, None) for c in ["", "a", "ab", "b", "é", None, "zz"]], "t string, n int")
    got = df.select("t", interleaved_key(df, ["t"], 3).alias("k")).collect()
    ordered = sorted(got, key=lambda r: (r.t is not None, (r.t or "").encode()))
    assert [r.k for r in ordered] == sorted(r.k for r in ordered) and ordered[-1].k > 0
    assert interleaved_key(df.limit(0), ["t", "n"]) is not None
    with pytest.raises(ValueError, match="62"):
        interleaved_key(df, ["t"], 63)
