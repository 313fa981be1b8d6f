"""The plans Spark makes: no Python in the hot path, no nested loops, no shuffle too many."""

import re

import pytest
from pyspark.sql import functions as F

from checks.registry import QUERIES, on_keyed  # noqa: F401
from small_tables import SMALL, rows
from ledgerlark.operators import clean as K
from ledgerlark.operators import identity as I
from ledgerlark.operators import quality as Q
from ledgerlark.operators import scoring as R
from ledgerlark.plans import marts as M
from ledgerlark.plans import unified as U


@pytest.fixture
def large(spark):
    """Plan as for large tables: no side is small enough to be broadcast by size."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield spark
    for name in names:
        spark.conf.unset(name)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df)


def shuffles(df, key):
    """Shuffles on ``key`` in the final plan, reused ones not counted."""
    text = final_plan(df).split("== Initial Plan ==")[0]
    return len(re.findall(rf"(?<!, )Exchange hashpartitioning\({key}#", text))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_nested_loop(large, name):
    text = plan(QUERIES[name](large, SMALL))
    for word in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "NestedLoopJoin", "CartesianProduct"):
        assert word not in text, word


def test_no_null_aware_anti_join(large, tables):
    bad = Q.bad_members({n: tables[n] for n in ("customers", "delinq", "detail")})
    for df in (R.score_pipeline(tables), R.score_pipeline(tables, bad=bad), Q.anti_join_bad(tables["loans"], bad)):
        assert not re.search(r"LeftAnti, BuildRight, true", plan(df))


def test_member_joins_of_the_score_share_a_partitioning(large, tables):
    """Detail, delinq, customers, payments, loans: one shuffle each, and two small key counts."""
    assert shuffles(R.score_pipeline(tables), "member_id") <= 7
    assert shuffles(R.score_pipeline(tables), "loan_id") == 2


def test_single_pass_has_one_shuffle(large, tables):
    from checks.registry import keyed
    from ledgerlark.sources.scratch import materialize

    stored = materialize(keyed(large, SMALL), "keyed")
    text = final_plan(R.score_single_pass(stored)).split("== Initial Plan ==")[0]
    assert text.count("Exchange ") == 1
    assert "partial_max" in text


def test_unified_shuffles_each_table_once_by_member(large, tables):
    text = plan(U.unified_table(tables)).split("== Initial Plan ==")[-1]
    assert len(re.findall(r"Exchange hashpartitioning\(member_id#\d+, _place#", text)) == 4


def test_mean_reuses_the_distinct(large):
    from checks.registry import keyed

    text = final_plan(K.clean_customers(I.customers_entity(keyed(large, SMALL))))
    assert "Subquery" in text and "ReusedExchange" in text


def test_share_reuses_the_counts(large, tables):
    assert "ReusedExchange" in final_plan(M.mart_status_share(tables["loans"]))


def test_columns_and_filters_reach_the_scan(tables):
    text = plan(M.mart_issue_trend(tables["loans"]))
    assert "ReadSchema: struct<funded_amount:float,issue_date:string>" in text
    text = plan(Q.filter_key_prefix(tables["customers"], "e3b0").select("grade"))
    assert "StringStartsWith(member_id,e3b0)" in text
    assert "IsNotNull(loan_amount)" in plan(K.filter_not_null(tables["loans"], "loan_amount"))


def test_income_filter_is_below_the_distinct(large):
    from checks.registry import keyed

    lines = plan(K.distinct_customers(I.customers_entity(keyed(large, SMALL)))).splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    filters = [i for i, line in enumerate(lines) if "Filter" in line]
    assert filters and min(filters) > exchange


def test_top_k_keeps_a_heap_per_task(large, tables):
    assert "TakeOrderedAndProject" in plan(Q.top_k_members(tables["detail"], 5))


def test_repeats_are_counted_before_the_shuffle(large, tables):
    text = plan(Q.bad_members({n: tables[n] for n in ("customers", "delinq", "detail")}))
    assert "partial_" in text and text.count("Exchange hashpartitioning") == 1
    assert rows(Q.duplicate_keys(tables["detail"]))
    assert tables["detail"].groupBy("member_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").count() > 0
