"""The wide table stored as factors: same rows, stored size of the sum, not of the product."""

import pytest
from pyspark.sql import functions as F

from checks.registry import tables
from ledgerlark.operators.skew import SkewLimits
from ledgerlark.plans import factorised as X
from ledgerlark.plans import unified as U
from ledgerlark.sources.scratch import materialize
from small_tables import SMALL, rows

LOW = SkewLimits(max_keys=20, min_rows=5)


def fake(spark, t, counts):
    """Tables of a few members: rows per member and side; every other column is made from the row number."""
    out = {}
    for name, per_member in counts.items():
        df = t[name]
        data = [(m, i) for m, n in per_member.items() for i in range(n)]
        base = spark.createDataFrame(data, "m string, i long").repartition(3)
        made = []
        for field in df.schema:
            value = F.col("m") if field.name == "member_id" else F.col("i").cast(field.dataType)
            if field.name == "loan_id":
                value = F.concat(F.col("m"), F.col("i").cast("string"))
            made.append(value.cast(field.dataType).alias(field.name))
        out[name] = base.select(*made)
    out["repayments"] = t["repayments"].limit(0).unionByName(
        out["loans"].where("loan_amount % 3 = 0").select(
            *(F.col("loan_id") if f.name == "loan_id" else F.lit(1).cast(f.dataType).alias(f.name)
              for f in t["repayments"].schema)
        )
    )
    return out


CASES = {
    "one hot on all sides": {
        "customers": {"h": 3, "a": 1, "b": 2}, "loans": {"h": 25, "a": 2, "x": 3},
        "delinq": {"h": 12, "b": 1}, "detail": {"h": 7, "a": 1, "x": 9},
    },
    "hot side without customers": {
        "customers": {"a": 1}, "loans": {"h": 40, "a": 1}, "delinq": {}, "detail": {"h": 30},
    },
    "only customers": {"customers": {"a": 1, "h": 30}, "loans": {}, "delinq": {}, "detail": {}},
    "null member": {
        "customers": {None: 9, "a": 1}, "loans": {None: 4, "a": 1}, "delinq": {None: 2}, "detail": {"a": 2},
    },
    "nothing": {"customers": {}, "loans": {"a": 1}, "delinq": {}, "detail": {}},
}


@pytest.mark.parametrize("slice_rows", [1, 4, 1000])
@pytest.mark.parametrize("case", CASES)
def test_same_rows_as_the_joins(spark, case, slice_rows):
    t = fake(spark, tables(spark, SMALL), CASES[case])
    stored = materialize(X.factorised(t, slice_rows, LOW), "factors")
    assert stored.where(F.size("loans") > slice_rows).count() == 0
    plain = t["customers"].select(*X.S.UNIFIED_CUSTOMER)
    loans = U.loans_with_repayments(t["loans"], t["repayments"]).drop(U.REPAYMENT_MARK)
    for side in (loans, t["delinq"], t["detail"]):
        plain = plain.join(side.drop("ingest_date"), "member_id", "left")
    assert rows(X.wide_rows(stored)) == rows(U.unified_select(plain))


@pytest.fixture(scope="module")
def stored(spark):
    return materialize(X.factorised(tables(spark, SMALL)), "factors")


def test_stored_rows_grow_with_the_sum(spark, stored):
    t = tables(spark, SMALL)
    held = stored.select(*(F.coalesce(F.size(s), F.lit(0)).alias(s) for s in X.SIDES))
    sums = held.agg(*(F.sum(s).alias(s) for s in X.SIDES)).first()
    known = t["customers"].select("member_id").distinct()
    for side in X.SIDES:
        assert sums[side] == t[side].join(known, "member_id", "left_semi").count()
    assert stored.count() == known.count() < U.unified_table(t).count()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_light_members_are_expanded_without_a_shuffle(stored):
    light = plan(X.wide_rows(stored)).split("FileScan", 1)[0]
    assert light.count("Generate explode") == 4 and "Exchange" not in light


def test_only_the_arrays_in_use_are_read(stored):
    text = plan(X.wide_rows(stored).select("grade", "loan_status").groupBy("grade").count())
    assert "delinq_amnt" not in text.split("ReadSchema", 1)[1].split("\n")[0]


def test_view_over_a_stored_table(spark, stored):
    stored.write.mode("overwrite").saveAsTable("factors_t")
    shown = X.register_wide_view(spark, "factors_t", "factors_v")
    assert shown.columns == list(X.S.UNIFIED_COLUMNS)
    assert spark.sql("SELECT count(*) FROM factors_v WHERE loan_id IS NOT NULL").first()[0] > 0


def test_a_slice_has_rows(spark):
    with pytest.raises(ValueError, match="slice"):
        X.factorised(tables(spark, SMALL), 0)


def test_first_and_further_arrays_share_their_shuffles(spark, tables):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = X.factorised(tables, 20)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    dealt = [line for line in text.splitlines() if "_deal" in line and "hashpartitioning(" in line]
    assert len([line for line in dealt if "ReusedExchange" not in line]) == len(X.SIDES)


def test_arrays_of_all_sides_are_made_without_a_second_shuffle(spark, tables):
    """Rows, not arrays, are shuffled, and each side's rows once."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(X.factorised(tables, 20))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    above, union, below = text.partition("Union")
    assert union and "Exchange" not in above and above.count("Sort [") == 1
    assert "collect_list(loans" in above and "collect_list(loans" not in below


def test_many_small_tasks_and_known_counts_give_the_same_rows(spark, monkeypatch):
    t = fake(spark, tables(spark, SMALL), CASES["one hot on all sides"])
    sides = CASES["one hot on all sides"]
    known = [(m, *(sides[s].get(m, 0) for s in X.SIDES)) for m in ("h", "a", "b", "x")]
    counts = spark.createDataFrame(known, "member_id string, " + ", ".join(f"{s} long" for s in X.SIDES))
    want = rows(X.wide_rows(materialize(X.factorised(t, 4, LOW), "factors")))
    monkeypatch.setattr(X, "TASK_ROWS", 7)
    factors = X.factorised(t, 4, LOW, counts)
    assert factors.rdd.getNumPartitions() == 10
    stored = materialize(factors, "factors")
    assert rows(X.wide_rows(stored)) == want
    held = stored.where("member_id = 'h'")
    assert held.where("not sliced").count() == 0
    assert {s: held.agg(F.sum(F.size(s))).first()[0] for s in X.SIDES} == {s: sides[s]["h"] for s in X.SIDES}


def test_slices_of_several_sides_share_a_row(spark):
    """A sliced member has as many rows as its longest side has slices, each with an array of every side that goes on."""
    t = fake(spark, tables(spark, SMALL), CASES["one hot on all sides"])
    stored = materialize(X.factorised(t, 4), "factors").where("member_id = 'h'")
    assert stored.count() == 7 and stored.where("sliced").count() == 7
    assert [stored.where(F.col(s).isNotNull()).count() for s in X.SIDES] == [1, 7, 3, 2]
