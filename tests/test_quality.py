from pyspark.sql import functions as F

from ledgerlark.functions.keys import packed, unpacked
from ledgerlark.operators import quality as Q
from ledgerlark.sources.scratch import materialize
from small_tables import rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def keyed(spark, *keys):
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "member_id string, v int")


def three(spark):
    return {
        "customers": keyed(spark, "a", "a", "b", "c", "d"),
        "delinq": keyed(spark, "b", "b", "c"),
        "detail": keyed(spark, "a", "a", "b", "c", "d", "e", "e"),
    }


def test_bad_lists(spark):
    t = three(spark)
    assert rows(Q.union_bad(t)) == [("a",), ("a",), ("b",), ("e",)]
    assert rows(Q.bad_members(t)) == [("a",), ("b",), ("e",)]
    assert rows(Q.duplicate_keys(t["detail"])) == [("a",), ("e",)]


def test_without_repeated_equals_anti_join(spark):
    t = three(spark)
    bad = Q.bad_members(t)
    for name in t:
        expected = rows(Q.anti_join_bad(t[name], bad))
        assert rows(Q.without_repeated(name, t)) == expected
    assert rows(Q.without_repeated("customers", t), "member_id") == [("c",), ("d",)]


def test_unique_rows_of_every_type(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('a', 1, 1.5D, true, date'2020-01-01', cast(null as string)), "
        "('b', 1, 1.5D, true, date'2020-01-01', 'x'), ('b', 2, 1.5D, false, null, 'y') "
        "AS t(member_id, i, d, f, dt, s)"
    )
    assert rows(Q.unique_rows(df)) == [r for r in rows(df) if r[0] == "a"]
    assert Q.unique_rows(df).dtypes == df.dtypes


def test_bad_and_new_are_disjoint(tables):
    members = {n: tables[n] for n in ("customers", "delinq", "detail")}
    bad = Q.bad_members(members)
    assert bad.count() > 0
    for name in members:
        new = Q.without_repeated(name, members)
        assert new.join(bad, "member_id").count() == 0
        assert Q.verify_dedup(new).first().passed
    assert not Q.verify_dedup(tables["detail"]).first().passed


def test_verify_empty(spark):
    assert tuple(Q.verify_dedup(keyed(spark, "a").where("v > 5")).first()) == (0, True)


def test_counts(spark):
    df = keyed(spark, "a", "b", "a", None)
    assert Q.count_rows(df).first().total_rows == 4
    assert Q.count_distinct_members(df).first().distinct_members == 2
    assert Q.count_distinct_members(df, approximate=True).first().distinct_members == 2
    assert [tuple(r) for r in Q.value_counts(df, "member_id").collect()] == [("a", 2), (None, 1), ("b", 1)]
    assert [tuple(r) for r in Q.top_k_members(df, 1).collect()] == [("a", 2)]
    assert [tuple(r) for r in Q.members_repeated(df).collect()] == [("a", 2)]


def test_profiles(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert Q.profile_nulls(df).first().asDict() == {"a": 1, "b": 2}
    assert Q.profile_rules(df, {"big": df.a > 2, "none": df.a > 9}).first().asDict() == {"big": 1, "none": 0}


def test_prefix_and_equal(spark):
    df = keyed(spark, "abc", "abd", "x")
    assert rows(Q.filter_key_prefix(df, "ab"), "member_id") == [("abc",), ("abd",)]
    assert rows(Q.filter_key_equals(df, "x", "member_id"), "member_id") == [("x",)]


def test_members_are_counted_once_for_several_tables(spark):
    t = three(spark)
    t["customers"] = t["customers"].union(keyed(spark, None))
    stored = materialize(Q.repeated_members(t), "repeated")
    for name in t:
        new = Q.without_repeated(name, t, repeated=stored)
        assert rows(new) == rows(Q.without_repeated(name, t))
        # Of the tables only the named one is read, and its rows are not shuffled.
        assert len(new.inputFiles()) == len(stored.inputFiles())
        assert "hashpartitioning(member_id" not in plan(new)
    null_twice = {**t, "delinq": keyed(spark, None, None)}
    stored = materialize(Q.repeated_members(null_twice), "repeated")
    assert rows(Q.without_repeated("detail", null_twice, repeated=stored)) == []


def test_members_are_packed_in_the_shuffle(spark):
    ids = ["ab01" * 16, "AB01", "abc", "", "zz", "00", "é", "\x01", None]
    df = spark.createDataFrame([(k,) for k in ids], "member_id string")
    value = packed(F.col("member_id"))
    got = df.select("member_id", F.octet_length(value).alias("n"), unpacked(value).alias("back")).collect()
    assert [r.back for r in got] == ids
    assert (got[0].n, got[-1].n) == (33, None)
    counts = Q.member_row_counts({"one": df, "two": df.where("member_id > 'a'").union(df)})
    assert rows(counts, "member_id", "one", "two") == rows(
        df.selectExpr("member_id", "1 AS one", "CASE WHEN member_id > 'a' THEN 2 ELSE 1 END AS two")
    )
