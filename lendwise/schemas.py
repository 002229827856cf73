"""Declared schemas.

Fixed values that must equal the reference's: column names, their order and
types.  The ``*_RAW`` DDLs are the positional schemas the split files are read back
with; ``*_TABLE`` DDLs are the cleaned tables' columns, bound by name.
"""

# Positional schemas of the four split files (customers, loans, repayments,
# defaulters), as declared by the cleaning jobs.
CUSTOMERS_RAW = (
    "member_id string, emp_title string, emp_length string, "
    "home_ownership string, annual_inc float, addr_state string, "
    "zip_code string, country string, grade string, sub_grade string, "
    "verification_status string, tot_hi_cred_lim float, "
    "application_type string, annual_inc_joint float, "
    "verification_status_joint string")
LOANS_RAW = (
    "loan_id string, member_id string, loan_amount float, "
    "funded_amount float, loan_term_months string, interest_rate float, "
    "monthly_installment float, issue_date string, loan_status string, "
    "loan_purpose string, loan_title string")
REPAYMENTS_RAW = (
    "loan_id string, total_principal_received float, "
    "total_interest_received float, total_late_fee_received float, "
    "total_payment_received float, last_payment_amount float, "
    "last_payment_date string, next_payment_date string")
DEFAULTERS_RAW = (
    "member_id string, delinq_2yrs float, delinq_amnt float, pub_rec float, "
    "pub_rec_bankruptcies float, inq_last_6mths float, "
    "total_rec_late_fee float, mths_since_last_delinq float, "
    "mths_since_last_record float")

# Cleaned tables, bound by name.
CUSTOMERS_TABLE = (
    "member_id string, emp_title string, emp_length int, "
    "home_ownership string, annual_income float, address_state string, "
    "address_zipcode string, address_country string, grade string, "
    "sub_grade string, verification_status string, "
    "total_high_credit_limit float, application_type string, "
    "join_annual_income float, verification_status_joint string, "
    "ingest_date timestamp")
LOANS_TABLE = (
    "loan_id string, member_id string, loan_amount float, "
    "funded_amount float, loan_term_years int, interest_rate float, "
    "monthly_installment float, issue_date string, loan_status string, "
    "loan_purpose string, loan_title string, ingest_date timestamp")
REPAYMENTS_TABLE = (
    "loan_id string, total_principal_received float, "
    "total_interest_received float, total_late_fee_received float, "
    "total_payment_received float, last_payment_amount float, "
    "last_payment_date string, next_payment_date string, "
    "ingest_date timestamp")
DELINQ_TABLE = ("member_id string, delinq_2yrs int, delinq_amnt float, "
                "mths_since_last_delinq int")
RECORDS_TABLE = ("member_id string, pub_rec int, pub_rec_bankruptcies int, "
                 "inq_last_6mths int")

# Raw wide columns the pipeline reads (types as inferred from the raw file).
RAW_COLUMNS = (
    "id", "emp_title", "emp_length", "home_ownership", "annual_inc",
    "zip_code", "addr_state", "grade", "sub_grade", "verification_status",
    "tot_hi_cred_lim", "application_type", "annual_inc_joint",
    "verification_status_joint", "loan_amnt", "funded_amnt", "term",
    "int_rate", "installment", "issue_d", "loan_status", "purpose", "title",
    "total_rec_prncp", "total_rec_int", "total_rec_late_fee", "total_pymnt",
    "last_pymnt_amnt", "last_pymnt_d", "next_pymnt_d", "delinq_2yrs",
    "delinq_amnt", "pub_rec", "pub_rec_bankruptcies", "inq_last_6mths",
    "mths_since_last_delinq", "mths_since_last_record")


def names(ddl: str) -> list[str]:
    return [f.strip().split()[0] for f in ddl.split(",")]


# Declared schema for the raw accepted-loans CSV (the reference inferred it:
# text stays string, every number is double).  Declaring it avoids the extra
# inference pass and pins the text form numbers hash with in the member key.
_RAW_DOUBLES = {"annual_inc", "tot_hi_cred_lim", "annual_inc_joint", "loan_amnt",
                "funded_amnt", "int_rate", "installment", "total_rec_prncp",
                "total_rec_int", "total_rec_late_fee", "total_pymnt",
                "last_pymnt_amnt", "delinq_2yrs", "delinq_amnt", "pub_rec",
                "pub_rec_bankruptcies", "inq_last_6mths", "mths_since_last_delinq",
                "mths_since_last_record"}
RAW = ", ".join(f"{c} {'double' if c in _RAW_DOUBLES else 'string'}" for c in RAW_COLUMNS)
