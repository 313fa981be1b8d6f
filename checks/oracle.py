"""Independent SQL for every registered query, for DuckDB on the same Parquet tables.

Each query is one text: the common table expressions it needs and a final SELECT. Tables are named
``t_*``; the ones a text mentions are put in front of it. Whole numbers come out as BIGINT and
fractions as DOUBLE, like the widened Spark results.
"""

from __future__ import annotations

import re

from checks.fixture import helper_select, raw_select
from ledgerlark import schema as S


def _in_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _cols(names, prefix: str = "") -> str:
    return ", ".join(f"{prefix}{n}" for n in names)


def _text(name: str, alias: str | None = None) -> str:
    return f"nullif(trim({name}), '') AS {alias or name}"


def _month(column: str) -> str:
    return f"try_strptime({column}, '%b-%Y')"


TABLES = {
    "t_helpers": f"""SELECT {helper_select("strftime(o_orderdate,'%b-%Y')")}
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "t_raw": f"SELECT {raw_select()} FROM t_helpers",
    "t_keyed": f"""SELECT *, sha256(concat_ws('||', {_cols(S.IDENTITY_COLUMNS)})) AS name_sha2
        FROM t_raw""",
    # entities, with names by position and text trimmed
    "t_e_customers": f"""SELECT name_sha2 AS member_id, {_text("emp_title")}, {_text("emp_length")},
        {_text("home_ownership")}, annual_inc, {_text("addr_state")}, {_text("zip_code")},
        'USA' AS country, {_text("grade")}, {_text("sub_grade")}, {_text("verification_status")},
        tot_hi_cred_lim, {_text("application_type")}, annual_inc_joint,
        {_text("verification_status_joint")} FROM t_keyed""",
    "t_e_loans": f"""SELECT {_text("id", "loan_id")}, name_sha2 AS member_id,
        loan_amnt AS loan_amount, funded_amnt AS funded_amount, {_text("term", "loan_term_months")},
        int_rate AS interest_rate, installment AS monthly_installment,
        {_text("issue_d", "issue_date")}, {_text("loan_status")}, {_text("purpose", "loan_purpose")},
        {_text("title", "loan_title")} FROM t_keyed""",
    "t_e_repayments": f"""SELECT {_text("id", "loan_id")}, total_rec_prncp AS total_principal_received,
        total_rec_int AS total_interest_received, total_rec_late_fee AS total_late_fee_received,
        total_pymnt AS total_payment_received, last_pymnt_amnt AS last_payment_amount,
        {_text("last_pymnt_d", "last_payment_date")}, {_text("next_pymnt_d", "next_payment_date")}
        FROM t_keyed""",
    "t_e_defaulters": f"""SELECT name_sha2 AS member_id, {_cols(S.DEFAULTERS_SOURCE[1:])}
        FROM t_keyed""",
    # cleaning of customers, step by step
    "t_c_renamed": f"""SELECT {", ".join(
        f"{c} AS {S.CUSTOMER_RENAMES.get(c, c)}" for c in S.CUSTOMERS_SOURCE)} FROM t_e_customers""",
    "t_c_distinct": "SELECT DISTINCT * FROM t_c_renamed",
    "t_c_income": "SELECT * FROM t_c_distinct WHERE annual_income IS NOT NULL",
    "t_c_years": r"""SELECT * REPLACE (
        try_cast(regexp_replace(emp_length, '\D', '', 'g') AS BIGINT) AS emp_length) FROM t_c_income""",
    "t_c_mean": "SELECT cast(floor(avg(emp_length)) AS BIGINT) AS avg_emp_length FROM t_c_years",
    "t_c_filled": """SELECT * REPLACE (
        coalesce(emp_length, (SELECT avg_emp_length FROM t_c_mean)) AS emp_length) FROM t_c_years""",
    "t_customers": """SELECT * REPLACE (
        CASE WHEN length(address_state) > 2 THEN 'NA' ELSE address_state END AS address_state)
        FROM t_c_filled""",
    # loans
    "t_l_kept": f"""SELECT * FROM t_e_loans
        WHERE {" AND ".join(f"{c} IS NOT NULL" for c in S.LOAN_REQUIRED)}""",
    "t_l_term": """SELECT * EXCLUDE (loan_term_months),
        cast(try_cast(replace(loan_term_months, ' months', '') AS BIGINT) // 12 AS BIGINT)
        AS loan_term_years FROM t_l_kept""",
    "t_loans": f"""SELECT * REPLACE (CASE WHEN loan_purpose IN ({_in_list(S.LOAN_PURPOSES)})
        THEN loan_purpose ELSE 'other' END AS loan_purpose) FROM t_l_term""",
    # repayments
    "t_r_kept": f"""SELECT * FROM t_e_repayments
        WHERE {" AND ".join(f"{c} IS NOT NULL" for c in S.REPAYMENT_REQUIRED)}""",
    "t_r_repaired": """SELECT * REPLACE (CASE
        WHEN total_principal_received <> 0 AND total_payment_received = 0
        THEN total_principal_received + total_interest_received + total_late_fee_received
        ELSE total_payment_received END AS total_payment_received) FROM t_r_kept""",
    "t_r_paid": "SELECT * FROM t_r_repaired WHERE total_payment_received <> 0",
    "t_repayments": """SELECT * REPLACE (
        CASE WHEN try_cast(last_payment_date AS DOUBLE) = 0 THEN NULL ELSE last_payment_date END
            AS last_payment_date,
        CASE WHEN try_cast(next_payment_date AS DOUBLE) = 0 THEN NULL ELSE next_payment_date END
            AS next_payment_date) FROM t_r_paid""",
    # defaulters
    "t_d_counted": """SELECT * REPLACE (
        coalesce(cast(trunc(delinq_2yrs) AS BIGINT), 0) AS delinq_2yrs) FROM t_e_defaulters""",
    "t_delinq": """SELECT member_id, delinq_2yrs, delinq_amnt,
        cast(trunc(mths_since_last_delinq) AS BIGINT) AS mths_since_last_delinq
        FROM t_d_counted WHERE delinq_2yrs > 0 OR mths_since_last_delinq > 0""",
    "t_d_records": f"""SELECT * REPLACE ({", ".join(
        f"coalesce(cast(trunc({c}) AS BIGINT), 0) AS {c}" for c in S.RECORD_COUNTS)})
        FROM t_d_counted""",
    "t_detail": f"SELECT member_id, {_cols(S.RECORD_COUNTS)} FROM t_d_records",
    # members with repeated rows
    "t_bad_customers": "SELECT member_id FROM t_customers GROUP BY member_id HAVING count(*) > 1",
    "t_bad_delinq": "SELECT member_id FROM t_delinq GROUP BY member_id HAVING count(*) > 1",
    "t_bad_detail": "SELECT member_id FROM t_detail GROUP BY member_id HAVING count(*) > 1",
    "t_bad_all": """SELECT * FROM t_bad_customers UNION ALL SELECT * FROM t_bad_delinq
        UNION ALL SELECT * FROM t_bad_detail""",
    "t_bad": "SELECT DISTINCT member_id FROM t_bad_all",
    "t_customers_new": "SELECT * FROM t_customers WHERE member_id NOT IN (SELECT member_id FROM t_bad)",
    "t_delinq_new": "SELECT * FROM t_delinq WHERE member_id NOT IN (SELECT member_id FROM t_bad)",
    "t_detail_new": "SELECT * FROM t_detail WHERE member_id NOT IN (SELECT member_id FROM t_bad)",
    "t_member_counts": """SELECT member_id, count(*) FILTER (WHERE kind = 1) AS customers,
        count(*) FILTER (WHERE kind = 2) AS loans, count(*) FILTER (WHERE kind = 3) AS delinq,
        count(*) FILTER (WHERE kind = 4) AS detail
        FROM (SELECT member_id, 1 AS kind FROM t_customers UNION ALL SELECT member_id, 2 FROM t_loans
            UNION ALL SELECT member_id, 3 FROM t_delinq UNION ALL SELECT member_id, 4 FROM t_detail)
        GROUP BY member_id""",
    # wide table, in the original join order
    "t_unified": f"""SELECT l.loan_id, {_cols(S.UNIFIED_CUSTOMER, "c.")}, {_cols(S.UNIFIED_LOAN, "l.")},
        {_cols(S.UNIFIED_REPAYMENT, "r.")}, {_cols(S.UNIFIED_DELINQUENCY, "d.")},
        {_cols(S.UNIFIED_DETAIL, "e.")}, r.loan_id AS repaid_id, d.member_id AS delinq_id,
        e.member_id AS detail_id
        FROM t_customers c LEFT JOIN t_loans l ON c.member_id = l.member_id
        LEFT JOIN t_repayments r ON l.loan_id = r.loan_id
        LEFT JOIN t_delinq d ON c.member_id = d.member_id
        LEFT JOIN t_detail e ON c.member_id = e.member_id""",
    "t_profile": """SELECT member_id, min(grade) AS grade, min(address_state) AS address_state,
        min(home_ownership) AS home_ownership, min(emp_length) AS emp_length,
        min(annual_income) AS annual_income FROM t_customers GROUP BY member_id""",
    "t_profiled": """SELECT p.*, l.loan_id, lower(l.loan_status) LIKE '%charged off%'
        OR lower(l.loan_status) LIKE '%default%' AS bad
        FROM t_loans l JOIN t_profile p ON l.member_id = p.member_id""",
}

DEFAULT_POINTS = {
    "unacceptable_rated_pts": 0, "very_bad_rated_pts": 100, "bad_rated_pts": 250,
    "good_rated_pts": 500, "very_good_rated_pts": 650, "excellent_rated_pts": 800,
    "unacceptable_grade_pts": 750, "very_bad_grade_pts": 1000, "bad_grade_pts": 1500,
    "good_grade_pts": 2000, "very_good_grade_pts": 2500,
}


def _count_case(column: str, many: int, pts: dict[str, int]) -> str:
    return (
        f"CASE WHEN {column} = 0 THEN {pts['excellent_rated_pts']} "
        f"WHEN {column} IN (1, 2) THEN {pts['bad_rated_pts']} "
        f"WHEN {column} IN (3, 4, 5) THEN {pts['very_bad_rated_pts']} "
        f"WHEN {column} > 5 OR {column} IS NULL THEN {many} END"
    )


def point_rules(pts: dict[str, int]) -> dict[str, str]:
    """CASE texts by points column; tables: l loan, p repayment, d delinq, e detail, c customer."""
    low, worst, bad, good, better, best = (
        pts[f"{n}_rated_pts"]
        for n in ("unacceptable", "very_bad", "bad", "good", "very_good", "excellent")
    )
    letters = {"A": best, "B": better, "C": good, "D": bad, "E": worst}
    grades = " ".join(
        f"WHEN c.grade = '{g}' AND c.sub_grade = '{g}{n + 1}' THEN {p} * (100 - 5 * {n}) / 100.0"
        for g, p in letters.items()
        for n in range(5)
    )
    shares = ((10, best), (20, better), (30, good), (50, bad), (70, worst))
    credit = " ".join(
        f"WHEN l.funded_amount <= c.total_high_credit_limit * {s} / 100.0 THEN {p}" for s, p in shares
    )
    ratio = "p.last_payment_amount / l.monthly_installment"
    return {
        "last_payment_pts": f"CASE WHEN {ratio} < 1 THEN {worst} WHEN {ratio} = 1 THEN {good} "
        f"WHEN {ratio} <= 1.5 THEN {better} WHEN {ratio} > 1.5 THEN {best} ELSE {low} END",
        "total_payment_pts": f"CASE WHEN p.total_payment_received * 2 >= l.funded_amount THEN {better} "
        f"WHEN p.total_payment_received > 0 THEN {good} "
        f"WHEN coalesce(p.total_payment_received, 0) = 0 THEN {low} END",
        "delinq_pts": _count_case("d.delinq_2yrs", pts["unacceptable_grade_pts"], pts),
        "public_records_pts": _count_case("e.pub_rec", worst, pts),
        "public_bankruptcies_pts": _count_case("e.pub_rec_bankruptcies", worst, pts),
        "enq_pts": _count_case("e.inq_last_6mths", low, pts),
        "loan_status_pts": "CASE WHEN l.loan_status ILIKE '%fully paid%' THEN {b} "
        "WHEN l.loan_status ILIKE '%current%' THEN {g} WHEN l.loan_status ILIKE '%in grace period%' "
        "THEN {m} WHEN l.loan_status ILIKE '%late (16-30 days)%' OR l.loan_status ILIKE "
        "'%late (31-120 days)%' THEN {w} ELSE {z} END".format(b=best, g=good, m=bad, w=worst, z=low),
        "home_pts": f"CASE WHEN c.home_ownership ILIKE '%own' THEN {best} "
        f"WHEN c.home_ownership ILIKE '%rent' THEN {good} "
        f"WHEN c.home_ownership ILIKE '%mortgage' THEN {bad} "
        f"WHEN c.home_ownership ILIKE '%any' OR c.home_ownership IS NULL THEN {worst} END",
        "credit_limit_pts": f"CASE {credit} ELSE {low} END",
        "grade_pts": f"CASE {grades} WHEN c.grade IN ('F', 'G') THEN {low} END",
    }


PAYMENT = ("last_payment_pts", "total_payment_pts")
DEFAULTS = ("delinq_pts", "public_records_pts", "public_bankruptcies_pts", "enq_pts")
HEALTH = ("loan_status_pts", "home_pts", "credit_limit_pts", "grade_pts")


def _rule(name: str, pts: dict[str, int] = DEFAULT_POINTS) -> str:
    kind = "DOUBLE" if name == "grade_pts" else "BIGINT"
    return f"cast({point_rules(pts)[name]} AS {kind}) AS {name}"


def _rules(names, pts: dict[str, int] = DEFAULT_POINTS) -> str:
    return ", ".join(_rule(n, pts) for n in names)


def score_tables(pts: dict[str, int], suffix: str = "") -> dict[str, str]:
    not_bad = "NOT IN (SELECT member_id FROM t_bad)"
    grade = " ".join(
        f"WHEN loan_score > {pts[f'{n}_grade_pts']} THEN '{g}'"
        for g, n in zip("ABCDE", ("very_good", "good", "bad", "very_bad", "unacceptable"), strict=True)
    )
    return {
        f"t_ph{suffix}": f"""SELECT l.member_id, {_rules(PAYMENT, pts)}
            FROM t_repayments p JOIN t_loans l ON l.loan_id = p.loan_id WHERE l.member_id {not_bad}""",
        f"t_ldh{suffix}": f"""SELECT h.*, {_rules(DEFAULTS, pts)} FROM t_detail e
            JOIN t_delinq d ON d.member_id = e.member_id
            JOIN t_ph{suffix} h ON h.member_id = e.member_id WHERE e.member_id {not_bad}""",
        f"t_fh{suffix}": f"""SELECT h.*, {_rules(HEALTH, pts)} FROM t_ldh{suffix} h
            JOIN t_loans l ON l.member_id = h.member_id
            JOIN t_customers c ON c.member_id = h.member_id WHERE h.member_id {not_bad}""",
        # whole hundredths, then exact division: the same doubles as the decimal results
        f"t_parts{suffix}": f"""SELECT member_id,
            20 * ({" + ".join(PAYMENT)}) / 100.0 AS payment_history_pts,
            45 * ({" + ".join(DEFAULTS)}) / 100.0 AS defaulters_history_pts,
            cast(cast(35 * ({" + ".join(HEALTH)}) AS DECIMAL(18,2)) AS DOUBLE) / 100 AS financial_health_pts
            FROM t_fh{suffix}""",
        f"t_scored{suffix}": f"""SELECT *, cast(cast(payment_history_pts AS DECIMAL(18,4))
            + cast(defaulters_history_pts AS DECIMAL(18,4))
            + cast(financial_health_pts AS DECIMAL(18,4)) AS DOUBLE) AS loan_score FROM t_parts{suffix}""",
        f"t_score{suffix}": f"""SELECT *, CASE {grade}
            WHEN loan_score IS NOT NULL THEN 'F' END AS loan_final_grade FROM t_scored{suffix}""",
    }


ALTERNATIVE_POINTS = {
    **DEFAULT_POINTS, "excellent_rated_pts": 900, "good_rated_pts": 450, "very_bad_rated_pts": 50,
    "very_good_grade_pts": 2600, "unacceptable_grade_pts": 700,
}
TABLES |= score_tables(DEFAULT_POINTS) | score_tables(ALTERNATIVE_POINTS, "_alt")


def with_tables(text: str) -> str:
    """Put the tables that ``text`` mentions, directly or through others, in front of it."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in re.findall(r"\bt_\w+", sql):
            if name not in TABLES:
                raise KeyError(name)
            if name not in needed:
                visit(TABLES[name])
                if name not in needed:
                    needed.append(name)

    visit(text)
    return "WITH " + ",\n".join(f"{n} AS ({TABLES[n]})" for n in needed) + f"\n{text}"


def _nulls(columns, table: str) -> str:
    return f"SELECT {', '.join(f'count(*) FILTER (WHERE {c} IS NULL) AS {c}' for c in columns)} FROM {table}"


def _counts(column: str, table: str, alias: str = "total") -> str:
    return f"SELECT {column}, count(*) AS {alias} FROM {table} GROUP BY {column}"


def _share(column: str, table: str) -> str:
    return f"""SELECT {column}, count(*) AS loans,
        round(count(*) / cast(sum(count(*)) OVER () AS DOUBLE), 6) AS share FROM {table} GROUP BY {column}"""


def _rate(column: str, name: str) -> str:
    return f"""SELECT {column} AS {name}, count(*) AS loans, count(*) FILTER (WHERE bad) AS defaulted,
        round(count(*) FILTER (WHERE bad) / cast(count(*) AS DOUBLE), 6) AS default_rate
        FROM t_profiled GROUP BY {column}"""


def _pts(name: str, keys: str, tables: str) -> str:
    return f"SELECT {keys}, {_rule(name)} FROM {tables}"


def _merged(columns, count: str, table: str) -> str:
    largest = ", ".join(f"max({c}) AS {c}" for c in columns)
    return f"SELECT member_id, count(*) AS {count}, {largest} FROM {table} GROUP BY member_id"


def _money(column: str) -> str:
    return f"cast(sum(cast({column} AS DECIMAL(18,2))) AS DOUBLE)"


ISSUE_YEAR = f"cast(year({_month('issue_date')}) AS BIGINT)"
LOANS_COLUMNS = (
    "loan_id, member_id, loan_amount, funded_amount, loan_term_years, interest_rate, "
    "monthly_installment, issue_date, loan_status, loan_purpose, loan_title"
)
LOAN_REPAYMENT = "t_repayments p JOIN t_loans l ON l.loan_id = p.loan_id"

UNIFIED_SUMS = (
    "annual_income", "total_high_credit_limit", "join_annual_income", "loan_amount", "funded_amount",
    "interest_rate", "monthly_installment", "total_principal_received", "total_interest_received",
    "total_late_fee_received", "delinq_amnt",
)
UNIFIED_INTS = (
    "emp_length", "loan_term_years", "delinq_2yrs", "mths_since_last_delinq", *S.RECORD_COUNTS,
)

CLEAN_COLUMNS = {
    "customers": [S.CUSTOMER_RENAMES.get(c, c) for c in S.CUSTOMERS_SOURCE],
    "loans": LOANS_COLUMNS.split(", "),
    "repayments": ["loan_id", *S.REPAYMENT_REQUIRED, "last_payment_date", "next_payment_date"],
    "delinq": ["member_id", *S.UNIFIED_DELINQUENCY],
    "detail": ["member_id", *S.RECORD_COUNTS],
}
RAW_ENTITIES = {
    "customers": S.CUSTOMERS_SOURCE,
    "loans": [c if c != "loan_term_years" else "loan_term_months" for c in LOANS_COLUMNS.split(", ")],
    "repayments": CLEAN_COLUMNS["repayments"],
    "defaulters": S.DEFAULTERS_SOURCE,
}


def _profile(table: str, step: str, source: str, columns) -> str:
    counts = {"rows": "count(*)"} | {f"null {c}": f"count(*) FILTER (WHERE {c} IS NULL)" for c in columns}
    pairs = ", ".join(f"{{'metric': '{m}', 'n': {n}}}" for m, n in counts.items())
    return f"SELECT '{table}' AS table_name, '{step}' AS step, unnest([{pairs}], recursive := true) FROM {source}"


def _rule_rows(table: str, step: str, query: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{step}' AS step, 'rule ' || metric AS metric, n
        FROM (UNPIVOT ({query}) ON COLUMNS(*) INTO NAME metric VALUE n)"""


REPAYMENT_RULES = """SELECT count(*) FILTER (WHERE total_payment_received = 0) AS zero_payment,
        count(*) FILTER (WHERE total_payment_received = 0 AND total_principal_received <> 0)
            AS inconsistent_zero_payment,
        count(*) FILTER (WHERE try_cast(last_payment_date AS DOUBLE) = 0) AS zero_last_payment_date,
        count(*) FILTER (WHERE try_cast(next_payment_date AS DOUBLE) = 0) AS zero_next_payment_date,
        count(*) FILTER (WHERE last_payment_date IS NULL) AS null_last_payment_date,
        count(*) FILTER (WHERE next_payment_date IS NULL) AS null_next_payment_date FROM t_r_kept"""
CUSTOMER_RULES = """SELECT
        count(*) FILTER (WHERE annual_income IS NULL) AS null_income,
        count(*) FILTER (WHERE emp_length IS NULL) AS null_emp_length,
        count(*) FILTER (WHERE length(address_state) > 2) AS long_state FROM t_c_distinct"""
MART_COLUMNS = {
    "mart_status_share": ("loan_status", "t_loans"), "mart_purpose_share": ("loan_purpose", "t_loans"),
    "mart_grade_share": ("grade", "t_profiled"), "mart_default_rate_state": ("address_state", None),
    "mart_default_rate_home": ("home_ownership", None), "mart_default_rate_emp": ("emp_length", None),
    "mart_default_rate_income": ("cast(floor(annual_income / 25000) * 25000 AS BIGINT)", None),
}


DIMENSION = "member_id, home_ownership, emp_length, annual_income, address_state, grade, sub_grade"
MOVED = "CASE WHEN address_state = 'CA' THEN 'WA' ELSE address_state END"


def _dimension(where: str, state: str) -> str:
    return f"""SELECT member_id, min(home_ownership) AS home_ownership, min(emp_length) AS emp_length,
        min(annual_income) AS annual_income, min({state}) AS address_state, min(grade) AS grade,
        min(sub_grade) AS sub_grade FROM t_customers WHERE {where} GROUP BY member_id"""


def _cube_part(mart: str, column: str, table: str | None) -> str:
    value = "share" if table else "default_rate"
    source = _share(column, table) if table else _rate(column, "value")
    name = column if table else "value"
    return f"SELECT '{mart}' AS mart, cast({name} AS VARCHAR) AS value, loans, {value} AS rate FROM ({source})"


FINAL = {
    # scans and sinks
    "scan_csv_inferred": "SELECT * FROM t_e_defaulters",
    "scan_csv_positional": "SELECT * FROM t_e_loans",
    "scan_parquet": "SELECT * FROM t_customers",
    "scan_table": "SELECT * FROM t_delinq",
    "sink_csv_single": "SELECT member_id FROM t_bad",
    "sink_csv": f"SELECT {LOANS_COLUMNS} FROM t_loans",
    "sink_parquet": "SELECT * FROM t_repayments",
    "sink_table": "SELECT * FROM t_detail",
    "sink_release": f"SELECT {LOANS_COLUMNS}, {ISSUE_YEAR} AS issue_year FROM t_loans",
    "sink_partitioned": f"SELECT {LOANS_COLUMNS}, {ISSUE_YEAR} AS issue_year FROM t_loans",
    "star_schema": f"""SELECT {ISSUE_YEAR} AS issue_year, p.grade, l.loan_status, count(*) AS loans,
        {_money("l.funded_amount")} AS funded_amount,
        {_money("l.total_payment_received")} AS total_payment_received
        FROM (SELECT l.*, r.total_payment_received FROM t_loans l LEFT JOIN t_repayments r
            ON l.loan_id = r.loan_id) l JOIN t_profile p ON l.member_id = p.member_id
        GROUP BY 1, 2, 3""",
    "star_schema_dim_customer": """SELECT member_id, min(home_ownership) AS home_ownership,
        min(emp_length) AS emp_length, min(annual_income) AS annual_income,
        min(address_state) AS address_state, min(grade) AS grade, min(sub_grade) AS sub_grade
        FROM t_customers GROUP BY member_id""",
    "star_schema_dim_issue_month": f"""SELECT DISTINCT issue_date, {ISSUE_YEAR} AS issue_year,
        cast(month({_month("issue_date")}) AS BIGINT) AS issue_month FROM t_loans""",
    "star_schema_fact_loan": """SELECT l.loan_id, l.member_id, l.issue_date, l.loan_status,
        l.loan_purpose, l.loan_term_years, l.funded_amount, l.interest_rate, r.total_payment_received
        FROM t_loans l LEFT JOIN t_repayments r ON l.loan_id = r.loan_id""",
    "unified_view": f"""SELECT loan_status, loan_purpose, count(*) AS n,
        count(DISTINCT member_id) AS members, count(loan_id) AS with_loan
        FROM t_unified GROUP BY loan_status, loan_purpose""",
    "dim_customer_history": f"""SELECT md5(valid_from || '|=' || member_id) AS customer_key, {DIMENSION},
            valid_from, valid_to FROM (
        SELECT a.*, cast(1 AS BIGINT) AS valid_from, CASE WHEN b.member_id IS NOT NULL AND (a IS DISTINCT FROM b)
            THEN cast(2 AS BIGINT) END AS valid_to FROM ({_dimension("annual_income < 100000", "address_state")}) a
            LEFT JOIN ({_dimension("annual_income >= 50000", MOVED)}) b ON a.member_id = b.member_id
        UNION ALL
        SELECT b.*, 2, NULL FROM ({_dimension("annual_income >= 50000", MOVED)}) b
            LEFT JOIN ({_dimension("annual_income < 100000", "address_state")}) a ON a.member_id = b.member_id
            WHERE a.member_id IS NULL OR a IS DISTINCT FROM b)""",
    # projections
    "member_identity": "SELECT * FROM t_keyed",
    "split_customers": f"""SELECT name_sha2 AS member_id, 'USA' AS country,
        {_cols(c for c in S.CUSTOMERS_SOURCE if c not in ("member_id", "country"))} FROM t_keyed""",
    "split_loans": f"SELECT id AS loan_id, name_sha2 AS member_id, {_cols(S.LOANS_SOURCE[2:])} FROM t_keyed",
    "split_repayments": f"SELECT id AS loan_id, {_cols(S.REPAYMENTS_SOURCE[1:])} FROM t_keyed",
    "split_defaulters": f"SELECT name_sha2 AS member_id, {_cols(S.DEFAULTERS_SOURCE[1:])} FROM t_keyed",
    "rename_customers": "SELECT * FROM t_c_renamed",
    "add_ingest_ts": "SELECT *, '2020-01-01 00:00:00' AS ingest_date FROM t_e_loans",
    "unified_select": f"""SELECT grade, address_state, count(*) AS n, count(loan_id) AS loan_id,
        count(last_payment_date) AS last_payment_date, count(next_payment_date) AS next_payment_date,
        {", ".join(f"{_money(c)} AS {c}" for c in UNIFIED_SUMS)},
        {", ".join(f"cast(sum({c}) AS BIGINT) AS {c}" for c in UNIFIED_INTS)}
        FROM t_unified GROUP BY grade, address_state""",
    "delinquency_select": """SELECT member_id, delinq_2yrs, delinq_amnt,
        cast(trunc(mths_since_last_delinq) AS BIGINT) AS mths_since_last_delinq FROM t_d_counted""",
    "records_detail_select": f"SELECT member_id, {_cols(S.RECORD_COUNTS)} FROM t_d_records",
    # filters, joins, set operations
    "filter_not_null": "SELECT * FROM t_c_renamed WHERE annual_income IS NOT NULL",
    "drop_null_rows": "SELECT * FROM t_l_kept",
    "drop_null_rows_repayments": "SELECT * FROM t_r_kept",
    "filter_inconsistent_zero": """SELECT * FROM t_r_kept
        WHERE total_payment_received = 0 AND total_principal_received <> 0""",
    "filter_paid": "SELECT * FROM t_r_paid",
    "filter_delinquent": "SELECT * FROM t_d_counted WHERE delinq_2yrs > 0 OR mths_since_last_delinq > 0",
    "filter_records_enq": """SELECT member_id FROM t_d_counted
        WHERE pub_rec > 0 OR pub_rec_bankruptcies > 0 OR inq_last_6mths > 0""",
    "filter_key_prefix": f"SELECT * FROM t_keyed WHERE name_sha2 LIKE '{S.EMPTY_IDENTITY_PREFIX}%'",
    "filter_key_equals": "SELECT * FROM t_r_repaired WHERE loan_id = '1064'",
    "filter_too_long": "SELECT * FROM t_c_filled WHERE length(address_state) > 2",
    "filter_zero_date": "SELECT * FROM t_r_paid WHERE try_cast(last_payment_date AS DOUBLE) = 0",
    "join_loan_repayment": f"""SELECT {", ".join("l." + c for c in LOANS_COLUMNS.split(", "))},
        p.* EXCLUDE (loan_id) FROM {LOAN_REPAYMENT}""",
    "join_member_history": """SELECT e.*, d.* EXCLUDE (member_id), h.* EXCLUDE (member_id)
        FROM t_detail_new e JOIN t_delinq_new d ON d.member_id = e.member_id
        JOIN t_ph h ON h.member_id = e.member_id""",
    "join_member_health": f"""SELECT h.*, l.loan_id, l.loan_status, l.funded_amount, c.home_ownership,
        c.grade, c.sub_grade, c.total_high_credit_limit FROM t_ldh h
        JOIN t_loans l ON l.member_id = h.member_id
        JOIN t_customers_new c ON c.member_id = h.member_id""",
    "join_unified": """SELECT loan_id IS NOT NULL AS has_loan, repaid_id IS NOT NULL AS has_repayment,
        delinq_id IS NOT NULL AS has_delinq, detail_id IS NOT NULL AS has_detail, count(*) AS n,
        count(DISTINCT member_id) AS members, count(loan_id) AS loan_rows
        FROM t_unified GROUP BY ALL""",
    "anti_join_bad": f"""SELECT {LOANS_COLUMNS} FROM t_loans
        WHERE member_id NOT IN (SELECT member_id FROM t_bad)""",
    "union_bad": "SELECT member_id FROM t_bad_all",
    "union_bad_distinct": "SELECT member_id FROM t_bad",
    # aggregations
    "count_rows": "SELECT count(*) AS total_rows FROM t_keyed",
    "count_distinct_members": "SELECT count(DISTINCT name_sha2) AS distinct_members FROM t_keyed",
    "distinct_members_sketched": f"""SELECT {ISSUE_YEAR} AS issue_year, count(DISTINCT member_id) AS members,
        true AS near FROM t_loans GROUP BY 1
        UNION ALL SELECT NULL, count(DISTINCT member_id), true FROM t_loans""",
    "heavy_members_sketched": """SELECT member_id, n, cast(ceil(n / edge) AS BIGINT) AS slices
        FROM (SELECT member_id, count(*) AS n FROM t_loans GROUP BY member_id),
            (SELECT greatest(count(*) / 1000.0, 3) AS edge FROM t_loans) WHERE n > edge""",
    "profile_nulls": _nulls(
        ("loan_id", *S.REPAYMENT_REQUIRED, "last_payment_date", "next_payment_date"), "t_e_repayments"
    ),
    "profile_rules": REPAYMENT_RULES,
    "profile_rules_customers": CUSTOMER_RULES,
    "profile_observed": " UNION ALL ".join([
        *(_profile(n, "raw", f"t_e_{n}", c) for n, c in RAW_ENTITIES.items()),
        *(_profile(n, "clean", f"t_{n}", c) for n, c in CLEAN_COLUMNS.items()),
        _rule_rows("repayments", "raw", REPAYMENT_RULES),
        _rule_rows("customers", "distinct", CUSTOMER_RULES),
    ]),
    "rows_null_amount": "SELECT * FROM t_e_loans WHERE loan_amount IS NULL",
    "distinct_rows": "SELECT * FROM t_c_distinct",
    "distinct_values": "SELECT DISTINCT address_state FROM t_customers",
    "value_counts": _counts("loan_purpose", "t_l_kept"),
    "key_multiplicity": _counts("member_id", "t_customers"),
    "key_multiplicity_delinq": _counts("member_id", "t_delinq"),
    "key_multiplicity_detail": _counts("member_id", "t_detail"),
    "key_multiplicity_customers_new": _counts("member_id", "t_customers_new"),
    "member_counts": "SELECT * FROM t_member_counts",
    "members_repeated": "SELECT name_sha2, count(*) AS total_cnt FROM t_keyed GROUP BY 1 HAVING count(*) > 1",
    "duplicate_keys": "SELECT member_id FROM t_bad_customers",
    "duplicate_keys_delinq": "SELECT member_id FROM t_bad_delinq",
    "duplicate_keys_detail": "SELECT member_id FROM t_bad_detail",
    "avg_emp_length": "SELECT avg_emp_length FROM t_c_mean",
    "sort_counts": _counts("delinq_2yrs", "t_e_defaulters") + " ORDER BY total DESC, delinq_2yrs",
    "top_k_members": _counts("member_id", "t_detail") + " ORDER BY total DESC, member_id LIMIT 20",
    # cleaning
    "clean_emp_length": "SELECT * FROM t_c_years",
    "impute_emp_length": "SELECT * FROM t_c_filled",
    "clean_state": """SELECT * REPLACE (CASE WHEN length(address_state) > 2 THEN 'NA'
        ELSE address_state END AS address_state) FROM t_c_renamed""",
    "clean_term": "SELECT * FROM t_l_term",
    "clean_purpose": f"""SELECT * REPLACE (CASE WHEN loan_purpose IN ({_in_list(S.LOAN_PURPOSES)})
        THEN loan_purpose ELSE 'other' END AS loan_purpose) FROM t_l_kept""",
    "repair_total_payment": "SELECT * FROM t_r_repaired",
    "null_zero_dates": "SELECT * FROM t_repayments",
    "clean_counts": "SELECT * FROM t_d_records",
    "clean_customers": "SELECT * FROM t_customers",
    "clean_loans": f"SELECT {LOANS_COLUMNS} FROM t_loans",
    "clean_repayments": "SELECT * FROM t_repayments",
    "clean_delinquency": "SELECT * FROM t_delinq",
    "clean_records_detail": "SELECT * FROM t_detail",
    # scoring
    "score_params": "SELECT * FROM t_score_alt",
    "pts_last_payment": _pts("last_payment_pts", "l.loan_id", LOAN_REPAYMENT),
    "pts_total_payment": _pts("total_payment_pts", "l.loan_id", LOAN_REPAYMENT),
    "score_payment_history": "SELECT * FROM t_ph",
    "pts_delinquency": _pts("delinq_pts", "d.member_id", "t_delinq d"),
    "pts_public_records": _pts("public_records_pts", "e.member_id", "t_detail e"),
    "pts_bankruptcies": _pts("public_bankruptcies_pts", "e.member_id", "t_detail e"),
    "pts_enquiries": _pts("enq_pts", "e.member_id", "t_detail e"),
    "score_defaulter_history": "SELECT * FROM t_ldh",
    "pts_loan_status": _pts("loan_status_pts", "l.loan_id", "t_loans l"),
    "pts_home": _pts("home_pts", "c.member_id", "t_customers c"),
    "pts_credit_limit": _pts(
        "credit_limit_pts", "l.loan_id", "t_loans l JOIN t_customers_new c ON c.member_id = l.member_id"
    ),
    "pts_grade": _pts("grade_pts", "c.member_id", "t_customers c"),
    "score_financial_health": "SELECT * FROM t_fh",
    "score_components": "SELECT * FROM t_parts",
    "loan_score": "SELECT * FROM t_scored",
    "loan_final_grade": "SELECT * FROM t_score",
    "score_pipeline": "SELECT * FROM t_score",
    "score_with_bad_list": "SELECT * FROM t_score",
    "score_single_pass": "SELECT * FROM t_score",
    # marts
    "mart_status_share": _share("loan_status", "t_loans"),
    "mart_grade_share": _share("grade", "t_profiled"),
    "mart_purpose_share": _share("loan_purpose", "t_loans"),
    "mart_cube": " UNION ALL ".join(_cube_part(m, *c) for m, c in MART_COLUMNS.items()),
    "mart_issue_trend": f"""SELECT strftime({_month("issue_date")}, '%Y-%m') AS issue_month,
        count(*) AS loans, {_money("funded_amount")} AS funded_amount FROM t_loans GROUP BY 1""",
    "mart_repayment_trend": f"""SELECT strftime({_month("last_payment_date")}, '%Y-%m')
        AS payment_month, count(*) AS loans, {_money("last_payment_amount")} AS last_payment_amount,
        {_money("total_payment_received")} AS total_payment_received FROM t_repayments GROUP BY 1""",
    "mart_default_rate_state": _rate("address_state", "address_state"),
    "mart_default_rate_home": _rate("home_ownership", "home_ownership"),
    "mart_default_rate_emp": _rate("emp_length", "emp_length"),
    "mart_default_rate_income": _rate(
        "cast(floor(annual_income / 25000) * 25000 AS BIGINT)", "income_band"
    ),
    "mart_score_histogram": """SELECT cast(floor(loan_score / 250) * 250 AS BIGINT) AS score_bin,
        count(*) AS loans FROM t_score GROUP BY 1""",
    "mart_risk_category": """SELECT loan_final_grade, count(DISTINCT member_id) AS members,
        round(cast(sum(cast(loan_score AS DECIMAL(18,4))) AS DOUBLE) / count(loan_score), 4)
        AS mean_score FROM t_score GROUP BY loan_final_grade""",
    # quality composites
    "bad_members": "SELECT member_id FROM t_bad",
    "bad_members_from_counts": "SELECT member_id FROM t_bad",
    "customers_new_from_counts": "SELECT * FROM t_customers_new",
    "detail_new_from_counts": "SELECT * FROM t_detail_new",
    "customers_new": "SELECT * FROM t_customers_new",
    "delinq_new": "SELECT * FROM t_delinq_new",
    "detail_new": "SELECT * FROM t_detail_new",
    "verify_dedup": """SELECT max(n) AS most_rows, max(n) <= 1 AS passed
        FROM (SELECT count(*) AS n FROM t_customers_new GROUP BY member_id)""",
    "unified_table": f"SELECT {_cols(S.UNIFIED_COLUMNS)} FROM t_unified",
    "unified_factorised": f"SELECT {_cols(S.UNIFIED_COLUMNS)} FROM t_unified",
    "unified_factorised_sliced": f"SELECT {_cols(S.UNIFIED_COLUMNS)} FROM t_unified",
    "unified_table_loan_grain": f"""SELECT l.loan_id, {_cols(S.UNIFIED_CUSTOMER, "c.")},
        {_cols(S.UNIFIED_LOAN, "l.")}, {_cols(S.UNIFIED_REPAYMENT, "r.")},
        {_cols(S.UNIFIED_DELINQUENCY, "d.")}, {_cols(S.UNIFIED_DETAIL, "e.")},
        c.customer_rows, d.delinq_rows, e.detail_rows
        FROM ({_merged(S.UNIFIED_CUSTOMER[1:], "customer_rows", "t_customers")}) c
        LEFT JOIN ({_merged(S.UNIFIED_DELINQUENCY, "delinq_rows", "t_delinq")}) d
            ON c.member_id = d.member_id
        LEFT JOIN ({_merged(S.UNIFIED_DETAIL, "detail_rows", "t_detail")}) e
            ON c.member_id = e.member_id
        LEFT JOIN t_loans l ON c.member_id = l.member_id
        LEFT JOIN t_repayments r ON l.loan_id = r.loan_id""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_tables(text) for name, text in FINAL.items()}
