"""Column lists, entity layouts and the list of known loan purposes.

Everything in this module has to equal the data files' own layout for results to agree.
"""

# Columns of the raw loan file that the engine uses, with the type each is read as.
RAW_COLUMNS = {
    "id": "string",
    "emp_title": "string",
    "emp_length": "string",
    "home_ownership": "string",
    "annual_inc": "double",
    "zip_code": "string",
    "addr_state": "string",
    "grade": "string",
    "sub_grade": "string",
    "verification_status": "string",
    "tot_hi_cred_lim": "double",
    "application_type": "string",
    "annual_inc_joint": "double",
    "verification_status_joint": "string",
    "loan_amnt": "double",
    "funded_amnt": "double",
    "term": "string",
    "int_rate": "double",
    "installment": "double",
    "issue_d": "string",
    "loan_status": "string",
    "purpose": "string",
    "title": "string",
    "last_pymnt_amnt": "double",
    "total_rec_prncp": "double",
    "total_rec_int": "double",
    "total_rec_late_fee": "double",
    "total_pymnt": "double",
    "last_pymnt_d": "string",
    "next_pymnt_d": "string",
    "delinq_2yrs": "double",
    "delinq_amnt": "double",
    "pub_rec": "double",
    "pub_rec_bankruptcies": "double",
    "inq_last_6mths": "double",
    "mths_since_last_delinq": "double",
    "mths_since_last_record": "double",
}

# Columns whose joined text is hashed into the member key, in hash order, and their separator.
IDENTITY_COLUMNS = (
    "emp_title", "emp_length", "home_ownership", "annual_inc", "zip_code",
    "addr_state", "grade", "sub_grade", "verification_status",
)
IDENTITY_SEPARATOR = "||"
# SHA-256 of the empty text: the key of a row whose identity columns are all NULL.
EMPTY_IDENTITY_PREFIX = "e3b0c44298fc1c149"

# Source columns of each entity, in file order. `member_id` is the derived key.
CUSTOMERS_SOURCE = (
    "member_id", "emp_title", "emp_length", "home_ownership", "annual_inc", "addr_state",
    "zip_code", "country", "grade", "sub_grade", "verification_status", "tot_hi_cred_lim",
    "application_type", "annual_inc_joint", "verification_status_joint",
)
LOANS_SOURCE = (
    "loan_id", "member_id", "loan_amnt", "funded_amnt", "term", "int_rate", "installment",
    "issue_d", "loan_status", "purpose", "title",
)
REPAYMENTS_SOURCE = (
    "loan_id", "total_rec_prncp", "total_rec_int", "total_rec_late_fee", "total_pymnt",
    "last_pymnt_amnt", "last_pymnt_d", "next_pymnt_d",
)
DEFAULTERS_SOURCE = (
    "member_id", "delinq_2yrs", "delinq_amnt", "pub_rec", "pub_rec_bankruptcies",
    "inq_last_6mths", "total_rec_late_fee", "mths_since_last_delinq", "mths_since_last_record",
)

# Layouts the entity files are read with. Names are given to the file's columns by position.
CUSTOMERS_DDL = (
    "member_id string, emp_title string, emp_length string, home_ownership string, "
    "annual_inc float, addr_state string, zip_code string, country string, grade string, "
    "sub_grade string, verification_status string, tot_hi_cred_lim float, "
    "application_type string, annual_inc_joint float, verification_status_joint string"
)
LOANS_DDL = (
    "loan_id string, member_id string, loan_amount float, funded_amount float, "
    "loan_term_months string, interest_rate float, monthly_installment float, "
    "issue_date string, loan_status string, loan_purpose string, loan_title string"
)
REPAYMENTS_DDL = (
    "loan_id string, total_principal_received float, total_interest_received float, "
    "total_late_fee_received float, total_payment_received float, last_payment_amount float, "
    "last_payment_date string, next_payment_date string"
)
DEFAULTERS_DDL = (
    "member_id string, delinq_2yrs float, delinq_amnt float, pub_rec float, "
    "pub_rec_bankruptcies float, inq_last_6mths float, total_rec_late_fee float, "
    "mths_since_last_delinq float, mths_since_last_record float"
)

CUSTOMER_RENAMES = {
    "annual_inc": "annual_income",
    "addr_state": "address_state",
    "zip_code": "address_zipcode",
    "country": "address_country",
    "tot_hi_cred_lim": "total_high_credit_limit",
    "annual_inc_joint": "join_annual_income",
}

LOAN_REQUIRED = (
    "loan_amount", "funded_amount", "loan_term_months", "interest_rate",
    "monthly_installment", "issue_date", "loan_status", "loan_purpose",
)
REPAYMENT_REQUIRED = (
    "total_principal_received", "total_interest_received", "total_late_fee_received",
    "total_payment_received", "last_payment_amount",
)
RECORD_COUNTS = ("pub_rec", "pub_rec_bankruptcies", "inq_last_6mths")

LOAN_PURPOSES = (
    "debt_consolidation", "credit_card", "home_improvement", "other", "major_purchase",
    "medical", "small_business", "car", "vacation", "moving", "house", "wedding",
    "renewable_energy", "educational",
)

# Columns the unified table takes from each of its tables, in output order after `loan_id`.
UNIFIED_CUSTOMER = (
    "member_id", "emp_title", "emp_length", "home_ownership", "annual_income",
    "address_state", "address_zipcode", "address_country", "grade", "sub_grade",
    "verification_status", "total_high_credit_limit", "application_type",
    "join_annual_income", "verification_status_joint",
)
UNIFIED_LOAN = (
    "loan_amount", "funded_amount", "loan_term_years", "interest_rate",
    "monthly_installment", "issue_date", "loan_status", "loan_purpose",
)
UNIFIED_REPAYMENT = (
    "total_principal_received", "total_interest_received", "total_late_fee_received",
    "last_payment_date", "next_payment_date",
)
UNIFIED_DELINQUENCY = ("delinq_2yrs", "delinq_amnt", "mths_since_last_delinq")
UNIFIED_DETAIL = RECORD_COUNTS
UNIFIED_COLUMNS = (
    "loan_id", *UNIFIED_CUSTOMER, *UNIFIED_LOAN, *UNIFIED_REPAYMENT,
    *UNIFIED_DELINQUENCY, *UNIFIED_DETAIL,
)
