"""A state of rows per member that files are added to."""

import pytest

from checks.registry import keyed, members, tables
from ledgerlark.operators import member_counts as N
from ledgerlark.operators import quality as Q
from ledgerlark.operators import skew as W
from ledgerlark.sources.releases import current_release
from ledgerlark.sources.scratch import materialize
from small_tables import SMALL, rows


@pytest.fixture(scope="module")
def raw(spark):
    return materialize(keyed(spark, SMALL), "keyed")


@pytest.fixture(scope="module")
def counts(raw):
    return materialize(N.member_counts(N.file_state(raw)), "counts")


def test_counts_equal_the_clean_tables(spark, counts):
    t = tables(spark, SMALL)
    want = Q.member_row_counts({n: t[n] for n in N.KINDS})
    assert rows(counts, "member_id", *N.KINDS) == rows(want, "member_id", *N.KINDS)


def test_states_of_files_merge_in_any_order(raw):
    """Rows of a member are spread over three files; some customers stand in several of them."""
    repeated = raw.where("id % 5 = 0")
    files = [raw.where("id % 2 = 0"), raw.where("id % 2 = 1"), repeated]
    states = [N.file_state(f) for f in files]
    want = rows(N.file_state(files[0].unionByName(files[1]).unionByName(files[2])))
    assert rows(N.merge_states(*states)) == want
    assert rows(N.merge_states(N.merge_states(states[2], states[1]), states[0])) == want
    customers = rows(N.member_counts(N.merge_states(*states)), "member_id", "customers")
    assert customers == rows(N.member_counts(N.file_state(raw)), "member_id", "customers")


def test_lists_follow_from_the_counts(spark, counts):
    three = members(spark, SMALL)
    assert rows(N.bad_members_of(counts)) == rows(Q.bad_members(three))
    for kind, df in three.items():
        assert rows(N.repeated_in(counts, kind)) == rows(Q.duplicate_keys(df))
        assert rows(N.multiplicity_of(counts, kind)) == rows(Q.key_multiplicity(df))
    bad = N.bad_members_of(counts)
    known = N.rows_per_member(counts, "detail")
    new = Q.anti_join_bad(three["detail"], bad, limits=W.SkewLimits(50, 2), counts=known)
    assert rows(new) == rows(Q.without_repeated("detail", three))


def test_heavy_members_follow_from_the_counts(spark, counts):
    limits = W.SkewLimits(max_keys=100, min_rows=5)
    for kind in N.KINDS:
        want = W.heavy_keys(tables(spark, SMALL)[kind], "member_id", limits)
        assert rows(N.heavy_members_of(counts, kind, limits)) == rows(want)
    assert rows(N.heavy_members_of(counts, "loans", limits))


def test_files_are_added_to_the_stored_state_once(spark, raw, counts):
    prefix = "ledger_"
    N.add_file(spark, raw.where("id % 2 = 0"), "even.csv", prefix)
    first = current_release(spark, prefix)
    N.add_file(spark, raw.where("id % 2 = 1"), "odd.csv", prefix)
    assert rows(spark.table(f"{prefix}{N.COUNTS}"), *counts.columns) == rows(counts)
    assert rows(spark.table(f"{prefix}{N.FILES}")) == [("even.csv",), ("odd.csv",)]
    with pytest.raises(ValueError, match="already"):
        N.add_file(spark, raw, "odd.csv", prefix)
    assert rows(spark.table(f"{prefix}{N.COUNTS}"), *counts.columns) == rows(counts)
    assert current_release(spark, prefix) != first


def test_an_empty_file_changes_nothing(raw):
    state = N.file_state(raw)
    assert rows(N.merge_states(state, N.file_state(raw.limit(0)))) == rows(state)


def test_null_members_go_as_with_not_in(spark):
    one = spark.createDataFrame([("a", 1), (None, 2)], "member_id string, v int")
    two = spark.createDataFrame([("b", 1), ("b", 2)], "member_id string, v int")
    assert rows(Q.without_repeated("one", {"one": one, "two": two.limit(1)})) == [(None, 2), ("a", 1)]
    assert rows(Q.without_repeated("one", {"one": one, "two": two})) == [("a", 1)]
    assert rows(Q.without_repeated("one", {"one": one.union(one.where("v = 2")), "two": two})) == []


def test_states_shuffle_packed_members(raw, counts):
    for df in (N.file_state(raw), N.member_counts(N.file_state(raw))):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "unhex(" in text.split("Exchange")[-1]
    assert all(len(r.member_id) == 64 for r in counts.select("member_id").limit(50).collect())
