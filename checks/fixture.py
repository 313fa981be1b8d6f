"""The driver's ``orders`` and ``customer`` tables as a raw loan file (one order = one loan).

The expressions are plain SQL that Spark and DuckDB read alike; FIXTURES.md explains them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_NO_ID = "k % 97 = 0"
_LATE = "CASE WHEN ok % 10 = 3 THEN 15.0 ELSE 0.0 END"
_LETTER = "substr('ABCDEFG', cast(k % 7 as int) + 1, 1)"

# helper columns; {month} is the engine's own date formatting
HELPERS = {
    "ok": "o_orderkey",
    "seg": "c_mktsegment",
    "k": "CASE WHEN c_custkey % 25 = 0 THEN c_custkey ELSE 1000000 + o_orderkey END",
    "amt": "cast(floor(o_totalprice/10) as double)",
    "term_m": "CASE WHEN o_orderkey % 3 = 0 THEN 60 ELSE 36 END",
    "inst": (
        "cast(floor(cast(floor(o_totalprice/10) as double)/"
        "CASE WHEN o_orderkey % 3 = 0 THEN 60 ELSE 36 END) as double)"
    ),
    "mon": "{month}",
}

RAW_EXPRESSIONS = {
    "id": "cast(ok as string)",
    "emp_title": f"CASE WHEN {_NO_ID} THEN NULL ELSE concat(seg, '-', cast(k as string)) END",
    "emp_length": (
        f"CASE WHEN {_NO_ID} THEN NULL WHEN k % 13 = 0 THEN 'n/a' WHEN k % 13 = 1 THEN '< 1 year' "
        "WHEN k % 13 >= 10 THEN '10+ years' ELSE concat(cast(k % 13 as string), ' years') END"
    ),
    "home_ownership": (
        f"CASE WHEN {_NO_ID} THEN NULL WHEN k % 6 = 0 THEN 'OWN' WHEN k % 6 = 1 THEN 'RENT' "
        "WHEN k % 6 = 2 THEN 'MORTGAGE' WHEN k % 6 = 3 THEN 'ANY' WHEN k % 6 = 4 THEN 'OTHER' "
        "ELSE 'RENT' END"
    ),
    "annual_inc": (
        f"CASE WHEN {_NO_ID} OR k % 101 = 0 THEN NULL "
        "ELSE cast(20000 + (k % 180) * 1000 as double) END"
    ),
    "zip_code": (
        f"CASE WHEN {_NO_ID} THEN NULL "
        "ELSE concat(substr(cast(1000000 + k as string), 2, 3), 'xx') END"
    ),
    "addr_state": (
        f"CASE WHEN {_NO_ID} THEN NULL WHEN k % 53 = 0 THEN 'refinance debt' "
        "WHEN k % 3 = 0 THEN 'CA' WHEN k % 3 = 1 THEN 'NY' ELSE 'TX' END"
    ),
    "grade": f"CASE WHEN {_NO_ID} THEN NULL ELSE {_LETTER} END",
    "sub_grade": (
        f"CASE WHEN {_NO_ID} THEN NULL "
        f"ELSE concat({_LETTER}, substr('12345', cast(k % 5 as int) + 1, 1)) END"
    ),
    "verification_status": (
        f"CASE WHEN {_NO_ID} THEN NULL WHEN k % 2 = 0 THEN 'Verified' ELSE 'Not Verified' END"
    ),
    "tot_hi_cred_lim": (
        "CASE WHEN ok % 23 = 0 THEN NULL ELSE cast(amt * CASE ok % 6 WHEN 0 THEN 20 WHEN 1 THEN 8 "
        "WHEN 2 THEN 4 WHEN 3 THEN 2.5 WHEN 4 THEN 1.75 ELSE 1.25 END as double) END"
    ),
    "application_type": "CASE WHEN ok % 29 = 0 THEN 'Joint App' ELSE 'Individual' END",
    "annual_inc_joint": "CASE WHEN ok % 29 = 0 THEN cast(30000 + ok % 70000 as double) ELSE NULL END",
    "verification_status_joint": "CASE WHEN ok % 29 = 0 THEN 'Verified' ELSE NULL END",
    "loan_amnt": "CASE WHEN ok % 211 = 0 THEN NULL ELSE amt END",
    "funded_amnt": "amt",
    "term": "concat(' ', cast(term_m as string), ' months')",
    "int_rate": "cast(5 + ok % 20 as double)",
    "installment": "inst",
    "issue_d": "mon",
    "loan_status": (
        "CASE ok % 9 WHEN 0 THEN 'Fully Paid' WHEN 1 THEN 'Current' WHEN 2 THEN 'In Grace Period' "
        "WHEN 3 THEN 'Late (16-30 days)' WHEN 4 THEN 'Late (31-120 days)' WHEN 5 THEN 'Charged Off' "
        "WHEN 6 THEN 'Default' "
        "WHEN 7 THEN 'Does not meet the credit policy. Status:Fully Paid' ELSE 'Current' END"
    ),
    "purpose": (
        "CASE ok % 8 WHEN 0 THEN 'debt_consolidation' WHEN 1 THEN 'credit_card' "
        "WHEN 2 THEN 'home_improvement' WHEN 3 THEN 'car' WHEN 4 THEN 'medical' "
        "WHEN 5 THEN 'Junk purpose' WHEN 6 THEN 'wedding' ELSE 'house' END"
    ),
    "title": "concat('Loan ', cast(ok as string))",
    "last_pymnt_amnt": (
        "cast(CASE ok % 8 WHEN 0 THEN 0.0 WHEN 1 THEN inst * 0.25 WHEN 2 THEN inst * 0.75 "
        "WHEN 3 THEN inst WHEN 4 THEN inst * 1.25 WHEN 5 THEN inst * 1.5 WHEN 6 THEN inst * 2 "
        "ELSE inst END as double)"
    ),
    "total_rec_prncp": (
        "cast(CASE WHEN ok % 199 = 0 THEN NULL ELSE CASE WHEN ok % 19 = 0 THEN 0.0 "
        "ELSE floor(amt * 0.25 * (1 + ok % 4)) END END as double)"
    ),
    "total_rec_int": "cast(CASE WHEN ok % 19 = 0 THEN 0.0 ELSE floor(amt * 0.125) END as double)",
    "total_rec_late_fee": f"cast({_LATE} as double)",
    "total_pymnt": (
        "cast(CASE WHEN ok % 19 = 0 OR ok % 31 = 0 THEN 0.0 "
        f"ELSE floor(amt * 0.25 * (1 + ok % 4)) + floor(amt * 0.125) + {_LATE} END as double)"
    ),
    "last_pymnt_d": "CASE WHEN ok % 37 = 0 THEN '0.0' WHEN ok % 41 = 0 THEN NULL ELSE mon END",
    "next_pymnt_d": "CASE WHEN ok % 43 = 0 THEN '0.0' WHEN ok % 9 = 0 THEN NULL ELSE mon END",
    "delinq_2yrs": (
        "cast(CASE ok % 11 WHEN 0 THEN NULL WHEN 1 THEN 1.0 WHEN 2 THEN 2.0 WHEN 3 THEN 3.0 "
        "WHEN 4 THEN 5.0 WHEN 5 THEN 6.0 WHEN 6 THEN 9.0 ELSE 0.0 END as double)"
    ),
    "delinq_amnt": "CASE WHEN ok % 11 BETWEEN 1 AND 6 THEN cast(ok % 500 as double) ELSE 0.0 END",
    "pub_rec": (
        "cast(CASE ok % 12 WHEN 0 THEN NULL WHEN 1 THEN 1.0 WHEN 2 THEN 4.0 WHEN 3 THEN 7.0 "
        "ELSE 0.0 END as double)"
    ),
    "pub_rec_bankruptcies": (
        "cast(CASE ok % 14 WHEN 0 THEN NULL WHEN 1 THEN 1.0 WHEN 2 THEN 3.0 WHEN 3 THEN 6.0 "
        "ELSE 0.0 END as double)"
    ),
    "inq_last_6mths": (
        "cast(CASE ok % 10 WHEN 0 THEN NULL WHEN 1 THEN 1.0 WHEN 2 THEN 3.0 WHEN 3 THEN 6.0 "
        "ELSE 0.0 END as double)"
    ),
    "mths_since_last_delinq": (
        "CASE WHEN ok % 11 BETWEEN 1 AND 6 OR ok % 2 = 0 THEN cast(1 + ok % 60 as double) "
        "ELSE NULL END"
    ),
    "mths_since_last_record": (
        "CASE WHEN ok % 12 BETWEEN 1 AND 3 THEN cast(1 + ok % 90 as double) ELSE NULL END"
    ),
}


def _select(expressions: dict[str, str]) -> str:
    return ", ".join(f"{text} AS {name}" for name, text in expressions.items())


def helper_select(month: str) -> str:
    return _select({n: t.replace("{month}", month) for n, t in HELPERS.items()})


def raw_select() -> str:
    return _select(RAW_EXPRESSIONS)


def raw_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey)
    month = "date_format(o_orderdate,'MMM-yyyy')"
    helpers = joined.selectExpr(
        *(f"{text.replace('{month}', month)} AS {name}" for name, text in HELPERS.items())
    )
    return helpers.selectExpr(*(f"{text} AS {name}" for name, text in RAW_EXPRESSIONS.items()))
