from ledgerlark.session import (
    INITIAL_PARTITIONS,
    MB,
    MOST_PARTITIONS,
    RECOMMENDED,
    SCAN_BYTES,
    TARGET_BYTES,
    shuffle_partitions,
    sized,
    stored_bytes,
    tune,
)


def test_partitions_follow_the_input():
    assert shuffle_partitions(10, 8) == 8
    assert shuffle_partitions(128 * MB * 1000, 200) == 1000
    assert shuffle_partitions(100 * 10**12, 200) == MOST_PARTITIONS


def test_small_input_changes_nothing():
    assert sized(50 * MB, 8) == {}


def test_large_input_gets_larger_tasks():
    assert sized(100 * 10**12, 200) == {
        INITIAL_PARTITIONS: str(MOST_PARTITIONS),
        SCAN_BYTES: str(10**9),
        TARGET_BYTES: str(256 * MB),
    }


def test_settings_are_applied(spark):
    assert tune(spark) is spark
    assert all(spark.conf.get(name) == value for name, value in RECOMMENDED.items())
    try:
        tune(spark, 128 * MB * 300)
        assert spark.conf.get(INITIAL_PARTITIONS) == "300"
    finally:
        spark.conf.unset(INITIAL_PARTITIONS)


def test_stored_bytes(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"x" * 10)
    (tmp_path / "b").write_bytes(b"x" * 5)
    assert stored_bytes(spark, str(tmp_path)) == 15
    assert stored_bytes(spark, str(tmp_path / "a"), str(tmp_path / "b")) == 15


def test_settings_of_a_larger_input_do_not_stay(spark):
    tune(spark, 100 * 10**12)
    tune(spark, MB)
    assert spark.conf.get(SCAN_BYTES) == "134217728b"
    assert spark.conf.get(INITIAL_PARTITIONS, None) is None


def test_stored_member_ids_take_half_their_text(spark, tmp_path):
    ids = spark.range(20_000).selectExpr("sha2(cast(id AS string), 256) AS member_id")
    tune(spark)
    ids.coalesce(1).write.parquet(str(tmp_path / "ids"))
    assert stored_bytes(spark, str(tmp_path / "ids")) < 20_000 * 48
