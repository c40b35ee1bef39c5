"""Project the keyed wide table onto the four entity tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gradewell import schemas


def split_customers(keyed: DataFrame) -> DataFrame:
    return keyed.withColumn("country", F.lit("USA")).select(*schemas.CUSTOMERS.fieldNames())


# Wide column behind each landed column of loans and repayments.
LOAN_SOURCES = {
    "loan_id": "id",
    "member_id": "member_id",
    "loan_amount": "loan_amnt",
    "funded_amount": "funded_amnt",
    "loan_term_months": "term",
    "interest_rate": "int_rate",
    "monthly_installment": "installment",
    "issue_date": "issue_d",
    "loan_status": "loan_status",
    "loan_purpose": "purpose",
    "loan_title": "title",
}
REPAYMENT_SOURCES = {
    "loan_id": "id",
    "total_principal_received": "total_rec_prncp",
    "total_interest_received": "total_rec_int",
    "total_late_fee_received": "total_rec_late_fee",
    "total_payment_received": "total_pymnt",
    "last_payment_amount": "last_pymnt_amnt",
    "last_payment_date": "last_pymnt_d",
    "next_payment_date": "next_pymnt_d",
}


def _project(keyed: DataFrame, sources: dict[str, str]) -> DataFrame:
    return keyed.select(*[F.col(source).alias(name) for name, source in sources.items()])


def split_loans(keyed: DataFrame) -> DataFrame:
    return _project(keyed, LOAN_SOURCES)


def split_repayments(keyed: DataFrame) -> DataFrame:
    return _project(keyed, REPAYMENT_SOURCES)


def split_defaulters(keyed: DataFrame) -> DataFrame:
    return keyed.select(*schemas.DEFAULTERS.fieldNames())


SPLITS = {
    "customers": split_customers,
    "loans": split_loans,
    "loans_repayments": split_repayments,
    "loans_defaulters": split_defaulters,
}
