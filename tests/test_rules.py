"""Each rule at its edges, in both profiles."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from gradewell.functions.bands import letter_grade
from gradewell.operators import score
from gradewell.params import CONF_KEYS, LITERAL, REPAIRED, ScoreParams
from gradewell.schemas import MONEY, SCORE

P = ScoreParams()
RULES = {"literal": LITERAL, "repaired": REPAIRED}


def evaluate(spark, expression, schema, rows):
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)],
                                  T.StructType([T.StructField("i", T.IntegerType()), *schema]))
    return [r["x"] for r in frame.select("i", expression.alias("x")).orderBy("i").collect()]


def money(*names):
    return [T.StructField(n, MONEY) for n in names]


def text(*names):
    return [T.StructField(n, T.StringType()) for n in names]


@pytest.mark.parametrize("profile,expected", [
    ("literal", [100, 500, 250, None, 650, None, 800, None]),
    ("repaired", [100, 250, 250, 500, 650, 800, 800, None]),
])
def test_last_payment(spark, profile, expected):
    amounts = [49, 50, 75, 100, 125, 150, 200, None]
    rows = [(None if a is None else Decimal(a), Decimal(100)) for a in amounts]
    schema = money("last_payment_amount", "monthly_installment")
    assert evaluate(spark, score.last_payment_points(P, RULES[profile]), schema, rows) == expected


@pytest.mark.parametrize("profile", RULES)
def test_last_payment_just_around_the_edges(spark, profile):
    amounts = ["49.99", "50.01", "99.99", "100.01", "149.99", "150.01"]
    rows = [(Decimal(a), Decimal(100)) for a in amounts]
    schema = money("last_payment_amount", "monthly_installment")
    assert evaluate(spark, score.last_payment_points(P, RULES[profile]), schema, rows) == [100, 250, 250, 650, 650, 800]


def test_total_payment(spark):
    rows = [(Decimal(t), Decimal(100)) for t in ("50", "49.99", "0.01", "0", "100")]
    schema = money("total_payment_received", "funded_amount")
    assert evaluate(spark, score.total_payment_points(P), schema, rows) == [650, 500, 500, 0, 650]


@pytest.mark.parametrize("profile,expected", [
    ("literal", [800, 500, 250, 100, 100, None, None, 0, None, None]),
    ("repaired", [800, 500, 250, 250, 100, 100, 0, 0, 0, 0]),
])
def test_funded_amount(spark, profile, expected):
    rows = [(Decimal(f), Decimal(100)) for f in (10, 20, 30, 40, 50, 60, 90, 100, 110)] + [(Decimal(1), None)]
    schema = money("funded_amount", "total_high_credit_limit")
    assert evaluate(spark, score.funded_points(P, RULES[profile]), schema, rows) == expected


def test_counts_of_own_column(spark):
    schema = [T.StructField("pub_rec", T.IntegerType())]
    rows = [(n,) for n in (0, 1, 2, 3, 5, 6, None)]
    assert evaluate(spark, score.count_points("pub_rec", P, REPAIRED), schema, rows) == [800, 250, 250, 100, 100, 0, 0]


def test_counts_with_the_literal_null_test(spark):
    schema = [T.StructField("pub_rec", T.IntegerType()), T.StructField("delinq_2yrs", T.IntegerType())]
    rows = [(0, 1), (0, None), (6, 1), (None, 1), (None, None)]
    assert evaluate(spark, score.count_points("pub_rec", P, LITERAL), schema, rows) == [800, 800, 0, None, 0]


STATUSES = ["Fully Paid", "Current", "In Grace Period", "Late (16-30 days)", "Late (31-120 days)",
            "Late (31 - 120 days)", "Charged Off", "Default", "Issued", None]


@pytest.mark.parametrize("profile,expected", [
    ("literal", [800, 500, 250, 100, None, 100, 0, None, None, None]),
    ("repaired", [800, 500, 250, 100, 100, 100, 0, 0, 0, 0]),
])
def test_loan_status(spark, profile, expected):
    rows = [(s,) for s in STATUSES]
    assert evaluate(spark, score.loan_status_points(P, RULES[profile]), text("loan_status"), rows) == expected


@pytest.mark.parametrize("profile,expected", [
    ("literal", [800, 500, 250, 0, None, None, None]),
    ("repaired", [800, 500, 250, 0, 0, 0, 0]),
])
def test_home(spark, profile, expected):
    rows = [(h,) for h in ("OWN", "RENT", "MORTGAGE", "ANY", "OTHER", None, "OWNER")]
    assert evaluate(spark, score.home_points(P, RULES[profile]), text("home_ownership"), rows) == expected


@pytest.mark.parametrize("profile,expected", [
    ("literal", [800, 500, 250, 100, 0, None, None, None]),
    ("repaired", [800, 500, 250, 100, 0, 0, 0, 0]),
])
def test_lender_grade(spark, profile, expected):
    rows = [("A", "A1"), ("B", "B5"), ("C", "C3"), ("D", "D2"), ("E", "E4"), ("F", "F1"), ("A", "B1"), (None, None)]
    assert evaluate(spark, score.lender_grade_points(P, RULES[profile]), text("grade", "sub_grade"), rows) == expected


@pytest.mark.parametrize("half_open,expected", [
    (True, ["A+", "B", "B", "C", "C", "D", "D", "E", "E", "F", "F", None]),
    (False, ["A+", None, "B", None, "C", None, "D", None, "E", "F", "F", None]),
])
def test_letter(spark, half_open, expected):
    totals = ["2500", "2499.50", "2000", "1999.50", "1500", "1499.50", "1000", "999.50", "750", "749.50", "0"]
    rows = [(Decimal(t),) for t in totals] + [(None,)]
    schema = [T.StructField("t", SCORE)]
    assert evaluate(spark, letter_grade("t", P, half_open), schema, rows) == expected


def test_params_from_conf(spark):
    key = CONF_KEYS["good"]
    try:
        assert ScoreParams.from_conf(spark) == ScoreParams()
        spark.conf.set(key, " 510 ")
        assert ScoreParams.from_conf(spark) == ScoreParams(good=510)
        ScoreParams(bad=1).to_conf(spark)
        assert ScoreParams.from_conf(spark) == ScoreParams(bad=1)
        assert spark.sql("select ${spark.sql.bad_rated_pts} as pts").first()["pts"] == 1
    finally:
        for name in CONF_KEYS.values():
            spark.conf.unset(name)


def test_sql_grade_agrees_with_the_columns(spark):
    rows = [("m", str(n), Decimal(0), Decimal(0), Decimal(0), Decimal(n) / 2) for n in range(0, 5760, 5)]
    schema = ("member_id string, loan_id string, payment_history_pts decimal(13,2), loan_default_history_pts decimal(13,2), "
              "financial_health_pts decimal(13,2), loan_total_score decimal(15,2)")
    totals = spark.createDataFrame(rows, schema)
    both = score.grade_in_sql(spark, totals).withColumn("other", letter_grade("loan_total_score", P))
    assert both.where(~F.col("loan_grade").eqNullSafe(F.col("other"))).count() == 0
