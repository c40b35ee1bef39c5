"""Cleaning steps on small inputs, and the person key."""

from __future__ import annotations

import hashlib
from decimal import Decimal

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Row, functions as F

from gradewell import schemas
from gradewell.functions.keys import member_id
from gradewell.operators import clean


def landed(spark, schema, rows):
    """Rows given by the values of a few columns; the rest is NULL."""
    return spark.createDataFrame([tuple(r.get(n) for n in schema.fieldNames()) for r in rows], schema)


def by_key(frame, key, column):
    return {r[key]: r[column] for r in frame.collect()}


def test_customers(spark):
    rows = [
        {"member_id": "a", "emp_length": "10+ years", "annual_inc": Decimal(1), "addr_state": "CA"},
        {"member_id": "b", "emp_length": "< 1 year", "annual_inc": Decimal(1), "addr_state": "Unknown"},
        {"member_id": "c", "emp_length": "n/a", "annual_inc": Decimal(1)},
        {"member_id": "d", "annual_inc": Decimal(1), "addr_state": "NY"},
        {"member_id": "e", "emp_length": "40 years", "addr_state": "NY"},
        {"member_id": "a", "emp_length": "10+ years", "annual_inc": Decimal(1), "addr_state": "CA"},
    ]
    cleaned = clean.clean_customers(landed(spark, schemas.CUSTOMERS, rows))
    assert by_key(cleaned, "member_id", "emp_length") == {"a": 10, "b": 1, "c": 5, "d": 5}
    assert by_key(cleaned, "member_id", "address_state") == {"a": "CA", "b": "NA", "c": None, "d": "NY"}
    assert cleaned.count() == 4
    assert {"annual_income", "address_zipcode", "address_country", "total_high_credit_limit",
            "join_annual_income"} <= set(cleaned.columns)


def loan(loan_id, **values):
    base = {"loan_id": loan_id, "member_id": "m", "loan_amount": Decimal(1), "funded_amount": Decimal(1),
            "loan_term_months": " 36 months", "interest_rate": Decimal(1), "monthly_installment": Decimal(1),
            "issue_date": "Jan-2019", "loan_status": "Current", "loan_purpose": "car"}
    return base | values


def test_loans(spark):
    rows = [loan("a"), loan("b", loan_term_months=" 60 months", loan_purpose="yacht"), loan("c", loan_term_months=None),
            loan("d", loan_term_months="40 months"), loan("e", loan_title=None, member_id=None),
            *[loan("x", **{column: None}) for column in clean.REQUIRED_LOAN_COLUMNS]]
    cleaned = clean.clean_loans(landed(spark, schemas.LOANS, rows))
    assert by_key(cleaned, "loan_id", "loan_term_years") == {"a": 3, "b": 5, "d": 3, "e": 3}
    assert by_key(cleaned, "loan_id", "loan_purpose")["b"] == "other"
    assert dict(cleaned.dtypes)["loan_term_years"] == "int"


def test_repayments(spark):
    def repayment(loan_id, principal, interest, fee, total, last=Decimal(1), paid=None, due=None):
        return {"loan_id": loan_id, "total_principal_received": principal, "total_interest_received": interest,
                "total_late_fee_received": fee, "total_payment_received": total, "last_payment_amount": last,
                "last_payment_date": paid, "next_payment_date": due}

    rows = [
        repayment("a", Decimal(100), Decimal(10), Decimal(1), Decimal(0), paid="0.0", due="Mar-2019"),
        repayment("b", Decimal(0), Decimal(10), Decimal(1), Decimal(0), paid="Mar-2019", due="0.0"),
        repayment("c", Decimal(100), Decimal(10), Decimal(1), Decimal(7)),
        repayment("d", Decimal(100), Decimal(10), Decimal(1), Decimal(7), last=None),
    ]
    cleaned = clean.clean_repayments(landed(spark, schemas.REPAYMENTS, rows))
    assert by_key(cleaned, "loan_id", "total_payment_received") == {"a": 111, "b": 0, "c": 7}
    assert by_key(cleaned, "loan_id", "last_payment_date") == {"a": None, "b": "Mar-2019", "c": None}
    assert by_key(cleaned, "loan_id", "next_payment_date") == {"a": "Mar-2019", "b": None, "c": None}


def test_defaulters(spark):
    rows = [
        {"member_id": "a", "delinq_2yrs": Decimal(2), "pub_rec": Decimal(1)},
        {"member_id": "b", "mths_since_last_delinq": Decimal("7.9")},
        {"member_id": "c", "inq_last_6mths": Decimal(1)},
        {"member_id": "d"},
        {"member_id": "d"},
        {"member_id": "d", "total_rec_late_fee": Decimal(3)},
    ]
    cleaned = clean.clean_defaulters(landed(spark, schemas.DEFAULTERS, rows))
    assert cleaned.count() == 5
    assert by_key(clean.delinquencies(cleaned), "member_id", "mths_since_last_delinq") == {"a": None, "b": 7}
    assert set(by_key(clean.records_and_enquiries(cleaned), "member_id", "pub_rec")) == {"a", "c"}
    details = clean.detail_records(cleaned)
    assert details.count() == 5
    assert by_key(details, "member_id", "inq_last_6mths") == {"a": 0, "b": 0, "c": 1, "d": 0}


def test_ingest_date_is_the_given_time(spark):
    stamped = clean.add_ingest_date(spark.range(2), "2024-01-31 12:00:00")
    assert dict(stamped.dtypes)["ingest_date"] == "timestamp"
    assert [str(r["ingest_date"]) for r in stamped.collect()] == ["2024-01-31 12:00:00"] * 2


def test_moved_nulls_share_an_id(spark):
    rows = [Row(a="x", b=None, c="y"), Row(a=None, b="x", c="y"), Row(a="x", b="y", c=None)]
    ids = spark.createDataFrame(rows, "a string, b string, c string").select(member_id(["a", "b", "c"]).alias("id"))
    assert ids.distinct().count() == 1


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(*[st.one_of(st.none(), st.text("abc |", max_size=3))] * 3), min_size=1, max_size=20))
def test_id_depends_on_the_key_alone(spark, rows):
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "i int, a string, b string, c string")
    ids = frame.select("i", member_id(["a", "b", "c"]).alias("id")).collect()
    for r in ids:
        joined = "||".join(v for v in rows[r["i"]] if v is not None)
        assert r["id"] == hashlib.sha256(joined.encode()).hexdigest()


def test_id_of_the_wide_table_uses_decimal_text(spark, tables):
    row = tables.keyed.where(F.col("annual_inc").isNotNull()).orderBy("id").first()
    values = [row[c] for c in schemas.KEY_COLUMNS]
    assert row["member_id"] == hashlib.sha256("||".join(str(v) for v in values if v is not None).encode()).hexdigest()
