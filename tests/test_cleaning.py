from datetime import date, datetime

from pyspark.sql import functions as F

from small_tables import rows
from ledgerlark import schema as S
from ledgerlark.functions import cleaning as C
from ledgerlark.operators import clean as K
from ledgerlark.operators import identity as I


def values(spark, kind, given, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(given)], f"i int, v {kind}")
    return [r.r for r in df.select("i", make(F.col("v")).alias("r")).orderBy("i").collect()]


def test_emp_length(spark):
    given = ["10+ years", "< 1 year", "7 years", "n/a", "", None, "99999999999 years"]
    assert values(spark, "string", given, C.emp_length_years) == [10, 1, 7, None, None, None, None]


def test_state(spark):
    assert values(spark, "string", ["CA", "refinance debt", "N", None], C.state_code) == ["CA", "NA", "N", None]


def test_term(spark):
    given = [" 36 months", "60 months", "40 months", "x", None]
    assert values(spark, "string", given, C.term_years) == [3, 5, 3, None, None]


def test_purpose(spark):
    given = [*S.LOAN_PURPOSES, "Junk", None]
    assert values(spark, "string", given, C.known_purpose) == [*S.LOAN_PURPOSES, "other", "other"]
    assert len(S.LOAN_PURPOSES) == 14


def test_zero_dates(spark):
    given = ["0.0", "0", "Dec-2018", None, "0.5"]
    assert values(spark, "string", given, C.null_if_zero_text) == [None, None, "Dec-2018", None, "0.5"]
    assert values(spark, "string", given, C.is_zero_text) == [True, True, None, None, False]


def test_counts_cut_off(spark):
    assert values(spark, "float", [2.7, None, 0.0, -1.5, float("nan")], C.count_or_zero)[:4] == [2, 0, 0, -1]


def test_month(spark):
    assert values(spark, "string", ["Dec-2018", "2018", None], C.month_start) == [date(2018, 12, 1), None, None]


def test_repair_then_filter(spark):
    ddl = S.REPAYMENTS_DDL
    given = [
        ("repaired", 10.0, 2.0, 1.0, 0.0, 5.0, "0.0", "Jan-2019"),
        ("both zero", 0.0, 2.0, 1.0, 0.0, 5.0, None, None),
        ("paid", 10.0, 2.0, 1.0, 99.0, 5.0, "Dec-2018", "0.0"),
        ("no principal", None, 2.0, 1.0, 9.0, 5.0, None, None),
        ("no last amount", 1.0, 2.0, 1.0, 9.0, None, None, None),
    ]
    cleaned = K.clean_repayments(spark.createDataFrame(given, ddl), datetime(2020, 1, 1))
    got = rows(cleaned, "loan_id", "total_payment_received", "last_payment_date", "next_payment_date")
    assert got == [("paid", 99.0, "Dec-2018", None), ("repaired", 13.0, None, "Jan-2019")]
    assert cleaned.columns[-1] == "ingest_date"


def customer(**changes):
    base = {
        "member_id": "m", "emp_title": "t", "emp_length": "2 years", "home_ownership": "OWN",
        "annual_inc": 1.0, "addr_state": "CA", "zip_code": "z", "country": "USA", "grade": "A",
        "sub_grade": "A1", "verification_status": "v", "tot_hi_cred_lim": 1.0,
        "application_type": "i", "annual_inc_joint": None, "verification_status_joint": None,
    }
    base.update(changes)
    return tuple(base[c] for c in S.CUSTOMERS_SOURCE)


def test_customers_mean_after_distinct_and_income_filter(spark):
    given = [
        customer(member_id="a", emp_length="10+ years"),
        customer(member_id="a", emp_length="10+ years"),  # copy: counts once in the mean
        customer(member_id="b", emp_length="3 years"),
        customer(member_id="c", emp_length="n/a", addr_state="California"),
        customer(member_id="d", emp_length="1 year", annual_inc=None),  # no income: not in the mean
    ]
    cleaned = K.clean_customers(spark.createDataFrame(given, S.CUSTOMERS_DDL), datetime(2020, 1, 1))
    assert rows(cleaned, "member_id", "emp_length", "address_state") == [
        ("a", 10, "CA"), ("b", 3, "CA"), ("c", 6, "NA"),
    ]
    assert cleaned.columns == [S.CUSTOMER_RENAMES.get(c, c) for c in S.CUSTOMERS_SOURCE] + ["ingest_date"]


def test_no_length_at_all_stays_null(spark):
    df = spark.createDataFrame([customer(emp_length="n/a")], S.CUSTOMERS_DDL)
    assert K.clean_customers(df).first().emp_length is None


def test_delinquency_and_records(spark):
    given = [
        ("none", None, 0.0, None, None, None, 0.0, None, None),
        ("count", 1.9, 5.0, 2.0, None, 1.0, 0.0, None, None),
        ("months only", None, 0.0, 0.0, 0.0, 0.0, 0.0, 7.5, None),
        ("zero months", 0.0, 0.0, 0.0, 3.0, None, 0.0, 0.0, None),
        ("below one", 0.4, 0.0, 0.4, 0.0, 0.0, 0.0, None, None),
    ]
    df = spark.createDataFrame(given, S.DEFAULTERS_DDL)
    assert rows(K.clean_delinquency(df)) == [("count", 1, 5.0, None), ("months only", 0, 0.0, 7)]
    assert rows(K.records_enquiries(df)) == [("below one",), ("count",), ("zero months",)]
    assert rows(K.clean_records_detail(df)) == [
        ("below one", 0, 0, 0), ("count", 2, 0, 1), ("months only", 0, 0, 0), ("none", 0, 0, 0),
        ("zero months", 0, 3, 0),
    ]


def test_cleaning_counts_twice_is_once(spark):
    given = [("a", 1.9, 5.0, 2.0, None, 1.0, 0.0, None, None)]
    once = K.clean_counts(spark.createDataFrame(given, S.DEFAULTERS_DDL), ["delinq_2yrs", *S.RECORD_COUNTS])
    assert rows(K.clean_counts(once, ["delinq_2yrs", *S.RECORD_COUNTS])) == rows(once)


def test_ingest_time_given_and_current(spark):
    df = spark.range(2)
    assert {r.ingest_date for r in K.add_ingest_ts(df, datetime(2020, 1, 1)).collect()} == {datetime(2020, 1, 1)}
    assert len({r.ingest_date for r in K.add_ingest_ts(df).collect()}) == 1


def test_conform_like_csv(spark, tmp_path):
    """Names, types and text come out as after writing and reading the entity as CSV."""
    given = [("1", " m ", 10.5, 1e7, " 36 months", None, 3.25, "", "a,\"b\"", "x", " ")]
    ddl = ("loan_id string, member_id string, loan_amnt double, funded_amnt double, term string, "
           "int_rate double, installment double, issue_d string, loan_status string, purpose string, title string")
    df = spark.createDataFrame(given, ddl)
    df.write.csv(str(tmp_path / "c"), header=True)
    through_csv = spark.read.schema(S.LOANS_DDL).csv(str(tmp_path / "c"), header=True)
    assert rows(I.conform(df, S.LOANS_DDL)) == rows(through_csv)
    assert I.conform(df, S.LOANS_DDL).dtypes == through_csv.dtypes


def test_conform_counts_columns(spark):
    try:
        I.conform(spark.range(1), "a int, b int")
    except ValueError:
        return
    raise AssertionError("expected an error")


def test_cleaned_tables_hold_the_rules(tables):
    customers, loans, repayments = tables["customers"], tables["loans"], tables["repayments"]
    assert customers.where("annual_income IS NULL OR emp_length IS NULL").count() == 0
    assert K.filter_too_long(customers).count() == 0
    assert {r[0] for r in loans.select("loan_purpose").distinct().collect()} <= set(S.LOAN_PURPOSES)
    assert K.filter_inconsistent_zero(repayments).count() == 0
    for column in ("last_payment_date", "next_payment_date"):
        assert K.filter_zero_date(repayments, column).count() == 0
    assert tables["delinq"].where("delinq_2yrs IS NULL").count() == 0
