"""Row counts and distributions that are known for sf0.01."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK
from gradewell.operators import clean, quality, score, wide
from gradewell.plans import queries


COUNTS = {
    "applications": 15_000, "customers": 1_512, "loans": 14_845, "repayments": 14_851, "defaulters": 2_281,
    "delinquencies": 2_182, "details": 2_281, "bad": 478,
}


@pytest.mark.parametrize("table", COUNTS)
def test_table_counts(tables, table):
    assert getattr(tables, table).count() == COUNTS[table]


def test_persons(tables):
    assert tables.keyed.select("member_id").distinct().count() == 1_500
    assert tables.customers.select("member_id").distinct().count() == 1_378


def test_records_and_enquiries(tables):
    assert clean.records_and_enquiries(tables.defaulters).count() == 1_860


def test_ranked_report_is_in_order(tables):
    rows = [(r["total"], r["member_id"]) for r in quality.ranked_duplicates(tables.details).collect()]
    assert len(rows) == 416
    assert rows == sorted(rows, key=lambda r: (-r[0], r[1]))


def test_preview_is_the_first_ten(spark, tables):
    ids = [r["id"] for r in queries.preview_top10(spark, SF_CHECK).collect()]
    assert ids == sorted(r["id"] for r in tables.applications.select("id").collect())[:10]


def test_mean_fill(tables):
    known = tables.customers.where("emp_length is not null")
    assert known.count() == 1_512
    landed = clean.dedupe(tables.landed("customers")).where("annual_inc is not null")
    digits = landed.select(F.regexp_replace("emp_length", "[^0-9]", "").try_cast("int").alias("n"))
    row = digits.agg(F.avg("n").alias("mean"), F.count_if(F.col("n").isNull()).alias("filled")).first()
    assert round(row["mean"], 4) == 5.0886
    assert row["filled"] == 237


def test_exclusion(tables):
    kept = queries._kept_defaulters(tables)
    assert quality.exclude(tables.customers, tables.bad, tables.hot).count() == 925
    assert clean.delinquencies(kept).count() == 987
    assert clean.detail_records(kept).count() == 1_022


def test_wide(tables):
    joined = wide.join_wide(tables.customers, tables.loans, tables.repayments, tables.delinquencies, tables.details,
                            tables.hot)
    assert joined.agg(F.sum("n_rows")).first()[0] == 48_522
    assert joined.count() == joined.select("loan_id").distinct().count()
    assert len(joined.columns) == len(set(joined.columns))
    assert queries.join_wide_clean(tables).count() == 8_717


def test_stages(tables):
    assert queries.payment_base(tables).count() == 14_698
    assert queries._payments(tables).count() == 9_992
    assert queries._history(tables).count() == 9_668


POINTS = {
    "last_payment_pts": {100: 1_229, 250: 2_540, 500: 1_259, 650: 1_223, 800: 2_466},
    "total_payment_received_pts": {0: 303, 500: 7_936, 650: 478},
    "delinq_pts": {0: 1_959, 100: 2_951, 250: 2_109, 800: 1_698},
    "public_record_pts": {0: 1_287, 100: 2_156, 250: 1_196, 800: 4_078},
    "public_bankruptcies_pts": {0: 1_276, 100: 1_537, 250: 1_251, 800: 4_653},
    "enq_pts": {0: 1_295, 100: 1_490, 250: 1_451, 800: 4_481},
    "loan_status_pts": {0: 2_178, 100: 2_189, 250: 1_089, 500: 1_080, 800: 2_181},
    "home_pts": {0: 4_806, 250: 916, 500: 2_154, 800: 841},
    "funded_amt_pts": {0: 1_153, 100: 1_657, 250: 2_245, 500: 2_375, 800: 1_287},
    "grade_pts": {0: 3_797, 100: 1_256, 250: 1_245, 500: 1_155, 800: 1_264},
}


def test_points(tables):
    points = queries._points(tables)
    levels = points.unpivot(["loan_id"], list(POINTS), "rule", "points").groupBy("rule", "points").count().collect()
    found = {}
    for row in levels:
        found.setdefault(row["rule"], {})[row["points"]] = row["count"]
    assert found == POINTS


def test_grades(tables):
    graded = queries.loan_grade(tables)
    assert {r["loan_grade"]: r["loans"] for r in score.grade_distribution(graded).collect()} == {
        "A+": 7, "B": 273, "C": 2_435, "D": 4_298, "E": 1_156, "F": 548}
    row = graded.agg(F.count("*").alias("rows"), F.countDistinct("loan_id").alias("loans"),
                     F.countDistinct("member_id").alias("members"), F.min("loan_total_score").alias("low"),
                     F.max("loan_total_score").alias("high"),
                     F.count_if(F.col("loan_total_score") % 2.5 != 0).alias("odd")).first()
    assert (row["rows"], row["loans"], row["members"], row["odd"]) == (8_717, 8_717, 895, 0)
    assert row["low"] >= 0 and row["high"] <= 2_880


def test_literal_grades(tables):
    graded = queries.loan_grade_literal(tables)
    row = graded.agg(F.sum("n_rows").alias("rows"),
                     F.sum(F.when(F.col("loan_grade").isNull(), F.col("n_rows"))).alias("ungraded")).first()
    assert (row["rows"], row["ungraded"]) == (94_532, 77_402)
    assert graded.select("member_id", *score.SUBSCORES).distinct().count() == graded.count()
