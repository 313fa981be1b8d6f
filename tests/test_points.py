from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlark.functions import points as P
from ledgerlark.functions.points import ScoreParams


def evaluate(spark, ddl, values, make):
    """Result of the rule for each input row, in order."""
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], f"i int, {ddl}")
    names = [n for n in df.columns if n != "i"]
    found = df.select("i", make(*(F.col(n) for n in names)).alias("r")).orderBy("i").collect()
    return [r.r for r in found]


def check(spark, ddl, cases, make):
    assert evaluate(spark, ddl, [c[0] for c in cases], make) == [c[1] for c in cases]


def test_last_payment(spark):
    cases = [
        ((49.99, 100.0), 100), ((50.0, 100.0), 100), ((99.99, 100.0), 100), ((100.0, 100.0), 500),
        ((100.01, 100.0), 650), ((150.0, 100.0), 650), ((150.01, 100.0), 800), ((0.0, 100.0), 100),
        ((None, 100.0), 0), ((100.0, None), 0), ((-3.0, -10.0), 800), ((-7.0, -10.0), 100),
    ]
    check(spark, "paid double, inst double", cases, P.last_payment_pts)


def test_part_payment_option(spark):
    params = ScoreParams(part_payment_pts=250)
    cases = [((49.0, 100.0), 100), ((50.0, 100.0), 250), ((99.0, 100.0), 250), ((100.0, 100.0), 500)]
    check(spark, "paid double, inst double", cases, lambda a, b: P.last_payment_pts(a, b, params))


def test_total_payment(spark):
    cases = [
        ((50.0, 100.0), 650), ((49.99, 100.0), 500), ((0.01, 100.0), 500), ((0.0, 100.0), 0),
        ((None, 100.0), 0), ((-1.0, 100.0), None), ((200.0, 100.0), 650), ((5.0, None), None),
    ]
    check(spark, "received double, funded double", cases, P.total_payment_pts)


@pytest.mark.parametrize(
    ("rule", "many"),
    [
        (P.delinquency_pts, 750), (P.public_record_pts, 100), (P.bankruptcy_pts, 100), (P.enquiry_pts, 0),
    ],
)
def test_counts(spark, rule, many):
    cases = [
        ((0,), 800), ((1,), 250), ((2,), 250), ((3,), 100), ((5,), 100), ((6,), many), ((99,), many),
        ((None,), many), ((-1,), None),
    ]
    check(spark, "n bigint", cases, rule)


def test_delinquency_option(spark):
    params = ScoreParams(many_delinquencies_earn_grade_limit=False)
    check(spark, "n bigint", [((6,), 0), ((None,), 0), ((0,), 800)], lambda n: P.delinquency_pts(n, params))


def test_loan_status(spark):
    cases = [
        (("Fully Paid",), 800), (("Current",), 500), (("In Grace Period",), 250),
        (("Late (16-30 days)",), 100), (("Late (31-120 days)",), 100), (("Charged Off",), 0),
        (("Default",), 0), ((None,), 0), (("late",), 0),
        (("Does not meet the credit policy. Status:Fully Paid",), 800),
        (("Does not meet the credit policy. Status:Charged Off",), 0),
        (("CURRENT, was fully paid",), 800),
    ]
    check(spark, "s string", cases, P.loan_status_pts)


def test_home(spark):
    cases = [
        (("OWN",), 800), (("rent",), 500), (("Mortgage",), 250), (("ANY",), 100), ((None,), 100),
        (("OTHER",), None), (("NONE",), None), (("own house",), None), (("we own",), 800),
    ]
    check(spark, "s string", cases, P.home_pts)
    params = ScoreParams(other_home_pts=7)
    check(spark, "s string", [(("OTHER",), 7), ((None,), 100)], lambda s: P.home_pts(s, params))


def test_credit_limit(spark):
    cases = [
        ((10.0, 100.0), 800), ((10.01, 100.0), 650), ((20.0, 100.0), 650), ((30.0, 100.0), 500),
        ((30.5, 100.0), 250), ((50.0, 100.0), 250), ((50.5, 100.0), 100), ((70.0, 100.0), 100),
        ((70.5, 100.0), 0), ((1.0, None), 0), ((None, 100.0), 0), ((5.0, 0.0), 0), ((0.0, 0.0), 800),
    ]
    check(spark, "funded double, cap double", cases, P.credit_limit_pts)


def test_grade_all_pairs(spark):
    base = {"A": 800, "B": 650, "C": 500, "D": 250, "E": 100}
    cases = [
        ((g, f"{g}{n + 1}"), Decimal(points * (100 - 5 * n)) / 100)
        for g, points in base.items() for n in range(5)
    ]
    cases += [
        (("F", "F1"), Decimal(0)), (("G", None), Decimal(0)), (("F", "A1"), Decimal(0)),
        (("A", "B1"), None), (("A", None), None), ((None, "A1"), None), (("A", "A6"), None),
        (("H", "H1"), None), (("A", "A"), None),
    ]
    check(spark, "g string, s string", cases, P.grade_pts)


def test_grade_type(spark):
    df = spark.createDataFrame([("A", "A1")], "g string, s string")
    assert df.select(P.grade_pts(F.col("g"), F.col("s")).alias("r")).dtypes == [("r", "decimal(12,2)")]


def test_final_grade(spark):
    edges = [
        ("2500.01", "A"), ("2500", "B"), ("2000.01", "B"), ("2000", "C"), ("1500.01", "C"),
        ("1500", "D"), ("1000.01", "D"), ("1000", "E"), ("750.01", "E"), ("750", "F"), ("0", "F"),
    ]
    cases = [((Decimal(v),), g) for v, g in edges] + [((None,), None)]
    check(spark, "s decimal(17,4)", cases, P.final_grade)


def test_params_from_conf(spark):
    assert len(ScoreParams.conf_names()) == 11
    assert ScoreParams.from_conf(spark) == ScoreParams()
    changed = ScoreParams(excellent_rated_pts=900, unacceptable_grade_pts=10)
    try:
        changed.to_conf(spark)
        assert ScoreParams.from_conf(spark) == changed
        assert spark.sql("SELECT ${spark.sql.excellent_rated_pts} AS p").first().p == 900
    finally:
        for name in ScoreParams.conf_names():
            spark.conf.unset(f"spark.sql.{name}")
