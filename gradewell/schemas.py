"""Declared schemas of the wide input and of the four entity tables."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
RATE = T.DecimalType(6, 2)
COUNT = T.DecimalType(6, 1)
SUBSCORE = T.DecimalType(13, 2)
SCORE = T.DecimalType(15, 2)
PAIR_COUNT = T.DecimalType(38, 0)
TEXT = T.StringType()


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


# The columns that make up the person key, in order.
KEY_COLUMNS = [
    "emp_title", "emp_length", "home_ownership", "annual_inc", "zip_code",
    "addr_state", "grade", "sub_grade", "verification_status",
]

# The wide input.
WIDE = _struct(
    ("id", TEXT),
    ("emp_title", TEXT), ("emp_length", TEXT), ("home_ownership", TEXT), ("annual_inc", MONEY),
    ("addr_state", TEXT), ("zip_code", TEXT), ("grade", TEXT), ("sub_grade", TEXT),
    ("verification_status", TEXT), ("tot_hi_cred_lim", MONEY), ("application_type", TEXT),
    ("annual_inc_joint", MONEY), ("verification_status_joint", TEXT),
    ("loan_amnt", MONEY), ("funded_amnt", MONEY), ("term", TEXT), ("int_rate", RATE),
    ("installment", MONEY), ("issue_d", TEXT), ("loan_status", TEXT), ("purpose", TEXT), ("title", TEXT),
    ("total_rec_prncp", MONEY), ("total_rec_int", MONEY), ("total_rec_late_fee", MONEY),
    ("total_pymnt", MONEY), ("last_pymnt_amnt", MONEY), ("last_pymnt_d", TEXT), ("next_pymnt_d", TEXT),
    ("delinq_2yrs", COUNT), ("delinq_amnt", MONEY), ("pub_rec", COUNT), ("pub_rec_bankruptcies", COUNT),
    ("inq_last_6mths", COUNT), ("mths_since_last_delinq", COUNT), ("mths_since_last_record", COUNT),
)

# The entity tables as landed. Files are read by position, so these names replace a file's header.
CUSTOMERS = _struct(
    ("member_id", TEXT), ("emp_title", TEXT), ("emp_length", TEXT), ("home_ownership", TEXT),
    ("annual_inc", MONEY), ("addr_state", TEXT), ("zip_code", TEXT), ("country", TEXT),
    ("grade", TEXT), ("sub_grade", TEXT), ("verification_status", TEXT), ("tot_hi_cred_lim", MONEY),
    ("application_type", TEXT), ("annual_inc_joint", MONEY), ("verification_status_joint", TEXT),
)
LOANS = _struct(
    ("loan_id", TEXT), ("member_id", TEXT), ("loan_amount", MONEY), ("funded_amount", MONEY),
    ("loan_term_months", TEXT), ("interest_rate", RATE), ("monthly_installment", MONEY),
    ("issue_date", TEXT), ("loan_status", TEXT), ("loan_purpose", TEXT), ("loan_title", TEXT),
)
REPAYMENTS = _struct(
    ("loan_id", TEXT), ("total_principal_received", MONEY), ("total_interest_received", MONEY),
    ("total_late_fee_received", MONEY), ("total_payment_received", MONEY), ("last_payment_amount", MONEY),
    ("last_payment_date", TEXT), ("next_payment_date", TEXT),
)
DEFAULTERS = _struct(
    ("member_id", TEXT), ("delinq_2yrs", COUNT), ("delinq_amnt", MONEY), ("pub_rec", COUNT),
    ("pub_rec_bankruptcies", COUNT), ("inq_last_6mths", COUNT), ("total_rec_late_fee", MONEY),
    ("mths_since_last_delinq", COUNT), ("mths_since_last_record", COUNT),
)

WHOLE = T.IntegerType()
INGESTED = ("ingest_date", T.TimestampType())
YEAR = ("issue_year", WHOLE)

# The entity tables once cleaned.
CLEAN_CUSTOMERS = _struct(
    ("member_id", TEXT), ("emp_title", TEXT), ("emp_length", WHOLE), ("home_ownership", TEXT),
    ("annual_income", MONEY), ("address_state", TEXT), ("address_zipcode", TEXT), ("address_country", TEXT),
    ("grade", TEXT), ("sub_grade", TEXT), ("verification_status", TEXT), ("total_high_credit_limit", MONEY),
    ("application_type", TEXT), ("join_annual_income", MONEY), ("verification_status_joint", TEXT), INGESTED,
)
CLEAN_LOANS = _struct(
    ("loan_id", TEXT), ("member_id", TEXT), ("loan_amount", MONEY), ("funded_amount", MONEY),
    ("loan_term_years", WHOLE), ("interest_rate", RATE), ("monthly_installment", MONEY),
    ("issue_date", TEXT), ("loan_status", TEXT), ("loan_purpose", TEXT), ("loan_title", TEXT), INGESTED,
)
CLEAN_REPAYMENTS = T.StructType(REPAYMENTS.fields + _struct(INGESTED).fields)
CLEAN_DEFAULTERS = _struct(
    ("member_id", TEXT), ("delinq_2yrs", WHOLE), ("delinq_amnt", MONEY), ("pub_rec", COUNT),
    ("pub_rec_bankruptcies", COUNT), ("inq_last_6mths", COUNT), ("total_rec_late_fee", MONEY),
    ("mths_since_last_delinq", COUNT), ("mths_since_last_record", COUNT), INGESTED,
)
DELINQUENCIES = _struct(
    ("member_id", TEXT), ("delinq_2yrs", WHOLE), ("delinq_amnt", MONEY), ("mths_since_last_delinq", WHOLE),
)
DETAILS = _struct(
    ("member_id", TEXT), ("pub_rec", WHOLE), ("pub_rec_bankruptcies", WHOLE), ("inq_last_6mths", WHOLE),
)
BAD_MEMBERS = _struct(("member_id", TEXT))


def _without(schema: T.StructType, *names: str) -> list[T.StructField]:
    return [field for field in schema if field.name not in names]


TOTAL_FILES = T.StructType([
    *_without(CLEAN_CUSTOMERS, "ingest_date"),
    *_without(CLEAN_LOANS, "member_id"),
    *_without(CLEAN_REPAYMENTS, "loan_id", "ingest_date"),
    *_without(DELINQUENCIES, "member_id"),
    *_without(DETAILS, "member_id"),
    *_struct(YEAR),
])
COUNTED_FILES = T.StructType([
    T.StructField("member_id", TEXT), *_without(CLEAN_LOANS, "member_id"),
    *_without(CLEAN_REPAYMENTS, "loan_id", "ingest_date"),
    *_struct(("n_customers", T.LongType()), ("n_delinq", T.LongType()), ("n_detail", T.LongType()), ("n_rows", PAIR_COUNT)),
])


def _classes(values: T.StructType) -> T.StructType:
    """Values shared by equal rows, with the counts that the factored join keeps of them."""
    counts = _struct(("n_members", T.LongType()), ("n_copies", T.LongType()), ("n_rows", PAIR_COUNT))
    return T.StructType([*_struct(("class_id", TEXT)), *_without(values, "member_id", "ingest_date"), *counts])


CUSTOMER_CLASSES = _classes(CLEAN_CUSTOMERS)
DELINQ_CLASSES = _classes(DELINQUENCIES)
DETAIL_CLASSES = _classes(DETAILS)
WIDE_MEMBERSHIP = _struct(("kind", TEXT), ("member_id", TEXT), ("class_id", TEXT), ("copies", T.LongType()))
WIDE_TOTALS = _struct(
    ("member_id", TEXT), ("n_customers", T.LongType()), ("n_delinq", T.LongType()), ("n_detail", T.LongType()), ("n_pairs", PAIR_COUNT))
SHARED_IDS = _struct(("member_id", TEXT), ("n_persons", T.LongType()))
BAD_CELLS = _struct(("id", TEXT), ("column_name", TEXT), ("cell", TEXT))
REPEATED_LOANS = _struct(("loan_id", TEXT), ("n_loans", T.LongType()), ("n_repayments", T.LongType()))
DROPPED_ROWS = _struct(("entity", TEXT), ("missing", TEXT), ("n_rows", T.LongType()))
MEMBER_SCORES = _struct(
    ("member_id", TEXT), ("payment_history_pts", SUBSCORE), ("loan_default_history_pts", SUBSCORE),
    ("financial_health_pts", SUBSCORE), ("loan_total_score", SCORE), ("loan_grade", TEXT), ("n_rows", PAIR_COUNT), INGESTED,
)
LOAN_SCORES = _struct(
    ("member_id", TEXT), ("loan_id", TEXT), ("payment_history_pts", SUBSCORE), ("loan_default_history_pts", SUBSCORE),
    ("financial_health_pts", SUBSCORE), ("loan_total_score", SCORE), ("loan_grade", TEXT), INGESTED, YEAR,
)
