"""Layouts of raw files, dimension versions, sketches."""

import pytest

from checks.registry import raw_loans, tables
from ledgerlark import schema as S
from ledgerlark.operators import sketches as K
from ledgerlark.operators import skew as W
from ledgerlark.plans import dimension as D
from ledgerlark.sources import drift
from small_tables import SMALL, rows

FIELDS = "member_id string, home_ownership string, emp_length bigint, annual_income double, "
FIELDS += "address_state string, grade string, sub_grade string"


def people(spark, **states):
    return spark.createDataFrame([(m, "OWN", 1, 2.0, s, "A", "A1") for m, s in states.items()], FIELDS)


def versions(dimension):
    return rows(dimension, "member_id", "address_state", "valid_from", "valid_to")


def test_changed_members_get_a_new_version(spark):
    first = D.first_load(people(spark, a="CA", b="NY"), 1)
    second = D.merge_load(first, people(spark, a="TX", c="CA"), 2)
    third = D.merge_load(second, people(spark, a="CA", b=None, c="CA"), 5)
    assert versions(third) == [
        ("a", "CA", 1, 2), ("a", "CA", 5, None), ("a", "TX", 2, 5), ("b", None, 5, None),
        ("b", "NY", 1, 5), ("c", "CA", 2, None),
    ]
    assert versions(D.version_at(third, 2)) == [("a", "TX", 2, 5), ("b", "NY", 1, 5), ("c", "CA", 2, None)]
    assert third.select(D.KEY).distinct().count() == third.count()
    assert D.current_version(third).count() == 3


def test_keys_are_stable_and_a_repeated_load_changes_nothing(spark):
    first = D.first_load(people(spark, a="CA", b="NY"), 1)
    load = people(spark, a="TX")
    second = D.merge_load(first, load, 2)
    assert rows(D.merge_load(second, load, 3)) == rows(second)
    assert rows(D.merge_load(second, load.limit(0), 3)) == rows(second)
    kept = {r[D.KEY] for r in first.collect()}
    assert kept < {r[D.KEY] for r in second.collect()}


def test_layout_changes_are_reported_before_a_run(spark, tmp_path):
    raw = raw_loans(spark, SMALL).limit(20)
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    raw.write.csv(good, header=True, ignoreLeadingWhiteSpace=False)
    columns = [c for c in raw.columns if c not in ("grade", "loan_amnt")]
    text = "CASE WHEN loan_amnt IS NULL THEN NULL ELSE concat(loan_amnt, ' USD') END AS loan_amnt"
    raw.selectExpr("'x' AS extra", *columns, text).write.csv(bad, header=True, ignoreLeadingWhiteSpace=False)
    stored = str(tmp_path / "layout")
    drift.write_layout(drift.layout_of(spark, good), stored)
    assert drift.report(spark, good, stored) == []
    found = drift.report(spark, bad, stored)
    assert {(c.kind, c.column) for c in found if c.kind != "moved"} == {
        ("missing", "grade"), ("added", "extra"), ("type", "loan_amnt")}
    assert any(c.kind == "moved" and c.column == "id" and "from column 1 to 2" in str(c) for c in found)
    assert not next(c for c in found if c.column == "extra").needed
    drift.check_header(spark, good)
    with pytest.raises(ValueError, match="lacks the columns grade"):
        drift.checked_raw_loans(spark, bad)


def test_heavy_keys_of_a_sketch_equal_the_exact_ones(spark):
    data = [(f"h{i % 7}",) for i in range(3000)] + [(f"l{i}",) for i in range(9000)] + [(None,)] * 5000
    df = spark.createDataFrame(data, "k string").repartition(5)
    for limits in (W.SkewLimits(200, 10), W.SkewLimits(20, 1), W.SkewLimits(5, 1)):
        want = rows(W.heavy_keys(df, "k", limits))
        assert rows(K.sketched_heavy_keys(df, "k", limits)) == want
        tracked = K.tracked_for(limits)
        halves = [df.where("k < 'l2'"), df.where("k >= 'l2' OR k IS NULL")]
        states = [K.frequent_state(h, "k", tracked, groups=2) for h in halves]
        merged = K.merge_frequent(states[0].union(states[1]), tracked)
        assert rows(K.sketched_heavy_keys(df, "k", limits, merged)) == want
    assert rows(K.sketched_heavy_keys(df.limit(0), "k")) == []


def test_member_sketches_merge(spark):
    loans = tables(spark, SMALL)["loans"]
    states = K.member_sketches(loans, "loan_status")
    whole = K.estimated_members(K.merge_sketches(states)).first()
    exact = loans.select("member_id").distinct().count()
    assert whole.rows == loans.count() and abs(whole.members - exact) <= 0.033 * exact
    assert set(S.RAW_COLUMNS) <= set(raw_loans(spark, SMALL).columns)
