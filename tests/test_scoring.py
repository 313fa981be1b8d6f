import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from checks.registry import ALTERNATIVE_PARAMS, raw_loans
from small_tables import SMALL, rows
from ledgerlark.functions.points import DEFAULT_PARAMS, ScoreParams
from ledgerlark.operators import identity as I
from ledgerlark.operators import quality as Q
from ledgerlark.operators import scoring as R
from ledgerlark.operators.skew import SkewLimits

LOW = SkewLimits(max_keys=20, min_rows=3)


def random_tables(spark, seed, members=14):
    """Small warehouse tables in which members have zero to three rows in each table."""
    rng = random.Random(seed)
    names = [f"m{i}" for i in range(members)]

    def some(*weights):
        return rng.choices(range(len(weights)), weights)[0]

    loans, repayments, customers, delinq, detail = [], [], [], [], []
    for m in names:
        for _ in range(some(1, 6, 3, 1)):
            loan = f"l{len(loans)}"
            loans.append((loan, m, float(rng.choice([100, 200])), 10.0,
                          rng.choice(["Fully Paid", "Current", "Charged Off", "Late (16-30 days)"])))
            for _ in range(some(1, 8, 1)):
                repayments.append((loan, float(rng.choice([4, 6, 10, 15, 16])), float(rng.choice([10, 100]))))
        for _ in range(some(1, 8, 1)):
            grade = rng.choice("ABCDEFG")
            customers.append((m, rng.choice(["OWN", "RENT", "ANY", "OTHER", None]), grade,
                              grade + rng.choice("12345"), rng.choice([150.0, 400.0, 4000.0, None])))
        for _ in range(some(2, 8, 1)):
            delinq.append((m, rng.choice([0, 1, 4, 9])))
        for _ in range(some(1, 8, 1)):
            detail.append((m, rng.choice([0, 1, 4, 9]), rng.choice([0, 2]), rng.choice([0, 5, 7])))
    return {
        "loans": spark.createDataFrame(
            loans, "loan_id string, member_id string, funded_amount double, monthly_installment double, loan_status string"),
        "repayments": spark.createDataFrame(
            repayments, "loan_id string, last_payment_amount double, total_payment_received double"),
        "customers": spark.createDataFrame(
            customers, "member_id string, home_ownership string, grade string, sub_grade string, total_high_credit_limit double"),
        "delinq": spark.createDataFrame(delinq, "member_id string, delinq_2yrs bigint"),
        "detail": spark.createDataFrame(
            detail, "member_id string, pub_rec bigint, pub_rec_bankruptcies bigint, inq_last_6mths bigint"),
    }


def brute_force(tables, bad, undelinquent=False):
    """Scores by nested loops over the collected rows."""
    t = {n: df.collect() for n, df in tables.items()}

    def count(n, many):
        return 800 if n == 0 else 250 if n <= 2 else 100 if n <= 5 else many

    found = []
    for loan in t["loans"]:
        m = loan.member_id
        if m in bad:
            continue
        for p in (p for p in t["repayments"] if p.loan_id == loan.loan_id):
            ratio = p.last_payment_amount / loan.monthly_installment
            last = 100 if ratio < 1 else 500 if ratio == 1 else 650 if ratio <= 1.5 else 800
            total = 650 if p.total_payment_received >= loan.funded_amount / 2 else 500
            delinquencies = [d.delinq_2yrs for d in t["delinq"] if d.member_id == m]
            if undelinquent and not delinquencies:
                delinquencies = [0]
            for e in (e for e in t["detail"] if e.member_id == m):
                for d in delinquencies:
                    history = (count(d, 750) + count(e.pub_rec, 100) + count(e.pub_rec_bankruptcies, 100)
                               + count(e.inq_last_6mths, 0))
                    for other in (o for o in t["loans"] if o.member_id == m):
                        for c in (c for c in t["customers"] if c.member_id == m):
                            found.append((m, score(last + total, history, other, c)))
    return Counter(found)


def score(payment, history, loan, customer):
    status = {"Fully Paid": 800, "Current": 500, "Charged Off": 0, "Late (16-30 days)": 100}[loan.loan_status]
    home = {"OWN": 800, "RENT": 500, "ANY": 100, None: 100}.get(customer.home_ownership)
    if home is None:
        return None
    limit = customer.total_high_credit_limit
    share = None if limit is None else loan.funded_amount / limit
    credit = 0 if share is None else next(
        (p for top, p in ((0.1, 800), (0.2, 650), (0.3, 500), (0.5, 250), (0.7, 100)) if share <= top), 0)
    base = {"A": 800, "B": 650, "C": 500, "D": 250, "E": 100}.get(customer.grade, 0)
    grade = Decimal(base * (105 - 5 * int(customer.sub_grade[1]))) / 100
    return (Decimal(payment) * 20 + Decimal(history) * 45 + (status + home + credit + grade) * 35) / 100


def counted(df):
    return Counter((r.member_id, r.loan_score) for r in df.collect())


@pytest.mark.parametrize("seed", range(2))
def test_pipeline_equals_brute_force(spark, seed):
    t = random_tables(spark, seed)
    members = {n: t[n] for n in ("customers", "delinq", "detail")}
    bad_list = Q.bad_members(members)
    bad = {r.member_id for r in bad_list.collect()}
    expected = brute_force(t, bad)
    assert bad and expected
    assert counted(R.score_pipeline(t)) == expected
    assert counted(R.score_pipeline(t, limits=LOW)) == expected
    assert counted(R.score_pipeline(t, bad=bad_list, limits=LOW)) == expected


def test_given_bad_list_is_used_as_it_is(spark):
    t = random_tables(spark, 7)
    listed = spark.createDataFrame([("m1",), ("m2",)], "member_id string")
    assert counted(R.score_pipeline(t, bad=listed)) == brute_force(t, {"m1", "m2"})


def test_members_without_delinquency_on_request(spark):
    t = random_tables(spark, 3)
    members = {n: t[n] for n in ("customers", "delinq", "detail")}
    bad_list = Q.bad_members(members)
    bad = {r.member_id for r in bad_list.collect()}
    params = ScoreParams(score_undelinquent=True)
    expected = brute_force(t, bad, undelinquent=True)
    assert expected != brute_force(t, bad)
    assert counted(R.score_pipeline(t, params=params)) == expected
    assert counted(R.score_pipeline(t, bad=bad_list, params=params)) == expected


def test_result_types_and_range(tables):
    scores = R.score_pipeline(tables)
    assert tuple(scores.columns) == R.SCORE_COLUMNS
    assert dict(scores.dtypes) == {
        "member_id": "string", "payment_history_pts": "decimal(13,2)",
        "defaulters_history_pts": "decimal(13,2)", "financial_health_pts": "decimal(16,4)",
        "loan_score": "decimal(17,4)", "loan_final_grade": "string",
    }
    assert scores.where("loan_score < 0 OR loan_score > 2850").count() == 0
    assert scores.where("(loan_score IS NULL) <> (loan_final_grade IS NULL)").count() == 0
    assert scores.count() == scores.select("member_id").distinct().count()


def test_no_bad_member_is_scored(tables):
    bad = Q.bad_members({n: tables[n] for n in ("customers", "delinq", "detail")})
    assert R.score_pipeline(tables).join(bad, "member_id").count() == 0


@pytest.mark.parametrize(
    "params",
    [
        DEFAULT_PARAMS,
        ALTERNATIVE_PARAMS,
        ScoreParams(score_undelinquent=True, other_home_pts=50, part_payment_pts=300),
        ScoreParams(many_delinquencies_earn_grade_limit=False),
    ],
)
def test_single_pass_equals_pipeline(spark, tables, params):
    keyed = I.member_identity(raw_loans(spark, SMALL))
    expected = rows(R.score_pipeline(tables, params=params))
    assert rows(R.score_single_pass(keyed, params)) == expected


def test_stages_equal_pipeline(tables):
    members = {n: tables[n] for n in ("customers", "delinq", "detail")}
    bad = Q.bad_members(members)
    payment = R.score_payment_history(tables["loans"], tables["repayments"], bad)
    history = R.score_defaulter_history(tables["detail"], tables["delinq"], payment, bad)
    health = R.score_financial_health(history, tables["loans"], tables["customers"], bad)
    assert rows(R.finish_score(health)) == rows(R.score_pipeline(tables))


def test_check_unique(spark):
    once = spark.createDataFrame([("a",), ("b",), (None,), (None,)], "id string")
    assert rows(Q.check_unique(once, "id")) == rows(once)
    with pytest.raises(PySparkException):
        Q.check_unique(once.union(once), "id").collect()
