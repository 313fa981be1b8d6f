import pytest

from checks.compare import difference, duck
from checks.oracle import FINAL, oracle_sql
from checks.registry import QUERIES
from small_tables import SMALL

FLAGSHIP = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(FINAL) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equal_to_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SMALL), con, oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ["score_pipeline", "score_single_pass", "customers_new", "join_unified"])
def test_equal_to_sql_at_larger_scale(spark, name):
    assert difference(QUERIES[name](spark, FLAGSHIP), duck(FLAGSHIP), oracle_sql()[name]) is None


def test_known_counts(spark):
    """Expected row counts of FIXTURES.md, section 4."""
    from checks.registry import members, raw_loans, tables
    from ledgerlark.operators import quality as Q

    t = tables(spark, FLAGSHIP)
    counts = {n: df.count() for n, df in t.items()}
    assert raw_loans(spark, FLAGSHIP).count() == 15000
    assert counts == {
        "customers": 14692, "loans": 14928, "repayments": 14138, "delinq": 11592, "detail": 15000,
    }
    three = members(spark, FLAGSHIP)
    assert Q.bad_members(three).count() == 60
    assert Q.without_repeated("customers", three).count() == 14099
    grades = {
        r.loan_final_grade: r["count"]
        for r in QUERIES["score_pipeline"](spark, FLAGSHIP).groupBy("loan_final_grade").count().collect()
    }
    assert grades == {"A": 30, "B": 1881, "C": 4279, "D": 1710, "E": 103, "F": 9, None: 2210}


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0
