"""The whole run: every file holds the table it is named after."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from gradewell import schemas
from gradewell.operators import clean, quality, score
from gradewell.params import LITERAL
from gradewell.plans import medallion
from gradewell.plans.queries import BATCH_TIME, QUERIES
from gradewell.plans.tables import Tables
from gradewell.sources import files
from gradewell.sources.applications import read_applications
from gradewell.sources.layout import Layout
from gradewell.sources.scratch import scratch_root


@pytest.fixture(scope="module")
def small(spark):
    return Tables.of(spark, SF_SMALL)


@pytest.fixture(scope="module")
def layout(spark, small, tmp_path_factory):
    return medallion.run(spark, small.applications, str(tmp_path_factory.mktemp("lake")), BATCH_TIME)


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    left, right = left.select(*columns), right.select(*columns)
    assert left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def expected(small):
    silver = {
        "customers": small.customers, "loans": small.loans, "loans_repayments": small.repayments,
        "loans_defaulters": small.defaulters, "loans_defaulters_delinq": small.delinquencies,
        "loans_defaulters_records_enq": clean.records_and_enquiries(small.defaulters),
        "loans_defaulters_detail_records_enq": small.details,
        "total_files_counted": QUERIES["join_wide"](small.spark, SF_SMALL),
        "wide_membership": small.factored.membership,
        "wide_totals": QUERIES["wide_totals"](small.spark, SF_SMALL),
        **{f"wide_{kind}_classes": classes for kind, classes in small.factored.classes.items()},
    }
    kept = quality.exclude(small.defaulters, small.bad, small.hot)
    gold = {
        "loans_defaulters": kept,
        "customers": quality.exclude(small.customers, small.bad, small.hot),
        "loans_defaulters_delinq": clean.delinquencies(kept),
        "loans_defaulters_detail_records_enq": clean.detail_records(kept),
        "loan_scores": QUERIES["loan_grade"](small.spark, SF_SMALL),
        "total_files": QUERIES["join_wide_clean"](small.spark, SF_SMALL),
    }
    bronze = {entity: small.landed(entity) for entity in
              ("customers", "loans", "loans_repayments", "loans_defaulters")}
    quarantine = {"bad_data": small.bad, "repeated_loans": quality.repeated_loans(small.loans, small.repayments),
                  "dropped_rows": QUERIES["dropped_rows"](small.spark, SF_SMALL),
                  "bad_cells": small.spark.createDataFrame([], schemas.BAD_CELLS),
                  "shared_ids": quality.shared_ids(small.keyed)}
    return {"bronze": bronze, "silver": silver, "quarantine": quarantine, "gold": gold}


def test_each_sink_holds_its_table(spark, small, layout):
    tables = expected(small)
    assert {(layer, entity) for layer in tables for entity in tables[layer]} == set(layout.tables())
    for layer, entity in layout.tables():
        written = spark.read.parquet(layout.path(layer, entity))
        assert written.schema == layout.schema(layer, entity)
        same(written.drop("ingest_date", "issue_year"), tables[layer][entity])


def test_one_batch_time(spark, layout):
    for layer, entity in [("silver", "customers"), ("silver", "loans"), ("gold", "loan_scores")]:
        stamps = spark.read.parquet(layout.path(layer, entity)).select("ingest_date").distinct().collect()
        assert [str(s["ingest_date"]) for s in stamps] == [BATCH_TIME]


def test_quarantine_is_disjoint_from_gold(spark, small, layout):
    bad = layout.read(spark, "quarantine", "bad_data")
    same(bad, small.bad)
    for entity in ("customers", "loans_defaulters_delinq", "loans_defaulters_detail_records_enq", "loan_scores"):
        assert spark.read.parquet(layout.path("gold", entity)).join(bad, "member_id", "left_semi").count() == 0


def test_rerun_replaces(spark, small, layout):
    before = spark.read.parquet(layout.path("gold", "loan_scores")).count()
    medallion.score_loans(spark, layout, BATCH_TIME)
    assert spark.read.parquet(layout.path("gold", "loan_scores")).count() == before


def test_csv_from_end_to_end(spark, small, layout, tmp_path):
    """Wide CSV with columns of its own in another order, and every layer in CSV, give the same tables."""
    raw = str(tmp_path / "raw")
    shuffled = small.applications.select(F.lit("x").alias("url"), *reversed(small.applications.columns))
    files.write_table(shuffled, raw, "csv")
    in_csv = Layout(str(tmp_path / "lake"), bronze_format="csv", table_format="csv")
    medallion.run(spark, read_applications(spark, raw, null_mark=files.NULL_MARK), in_csv, BATCH_TIME)
    for layer, entity in layout.tables():
        same(in_csv.read(spark, layer, entity), layout.read(spark, layer, entity))
    medallion.register_tables(spark, in_csv, "scoring_csv")
    same(spark.table("scoring_csv.gold_loan_scores"), layout.read(spark, "gold", "loan_scores"))
    spark.sql("drop database scoring_csv cascade")


def test_counted_wide_table(spark, layout):
    counted = layout.read(spark, "silver", "total_files_counted")
    assert counted.agg(F.sum("n_rows")).first()[0] == 4_899
    assert ("silver", "total_files_counted") in layout.tables()
    assert spark.read.parquet(layout.path("gold", "total_files")).count() == 888


def test_literal_run_counts_pairs(spark, layout, small):
    medallion.score_loans(spark, layout, BATCH_TIME, rules=LITERAL)
    pairs = layout.read(spark, "gold", "member_scores").drop("ingest_date")
    same(pairs, QUERIES["loan_grade_literal"](small.spark, SF_SMALL))
    medallion.score_loans(spark, layout, BATCH_TIME)


def test_scores_need_no_shuffle(spark, layout):
    graded = score.grade(score.score_wide(spark.read.parquet(layout.path("gold", "total_files"))))
    plan = graded._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_options_of_the_score(spark, layout):
    medallion.score_loans(spark, layout, BATCH_TIME, rules=LITERAL)
    graded = spark.read.parquet(layout.path("gold", "loan_scores"))
    assert graded.where("loan_grade is null").count() > 0
    medallion.score_loans(spark, layout, BATCH_TIME, include_clean_members=True)
    more = spark.read.parquet(layout.path("gold", "loan_scores")).count()
    medallion.score_loans(spark, layout, BATCH_TIME)
    assert more > spark.read.parquet(layout.path("gold", "loan_scores")).count() == 888


def test_views_and_catalog_tables(spark, layout):
    views = medallion.register_views(spark, layout, "v_")
    assert "v_gold_loan_scores" in views
    assert spark.sql("select count(*) as n from v_gold_loan_scores").first()["n"] == 888
    names = medallion.register_tables(spark, layout, "scoring_test")
    assert "scoring_test.silver_customers" in names
    assert spark.table("scoring_test.silver_customers").count() == 151
    query = """
        select count(*) as n from scoring_test.silver_loans l
        join scoring_test.gold_customers c on c.member_id = l.member_id
        where l.funded_amount <= c.total_high_credit_limit * :share"""
    assert spark.sql(query, args={"share": 1}).first()["n"] > 0
    spark.sql("drop database scoring_test cascade")
    assert spark.read.parquet(layout.path("silver", "customers")).count() == 151


def test_unknown_table():
    with pytest.raises(KeyError):
        Layout("/x").path("gold", "loans_repayments")


def test_malformed_cells(spark, tmp_path):
    path = str(tmp_path / "cells")
    spark.createDataFrame([("1", "x"), ("2", "2.50"), ("3", None)], "loan_id string, amount string").write.csv(
        path, header=True)
    from pyspark.sql import types as T

    from gradewell.schemas import MONEY
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("amt", MONEY)])
    rows = {r["id"]: r for r in files.read_csv(spark, path, schema, corrupt_column="bad").collect()}
    assert {k: None if r["amt"] is None else str(r["amt"]) for k, r in rows.items()} == {"1": None, "2": "2.50", "3": None}
    assert rows["1"]["bad"] == "1,x" and rows["2"]["bad"] is None


HOSTILE = [
    ("1", 'a "quoted", text', "007"), ("2", "back\\slash \\", ""), ("3", None, None), ("4", " blanks ", '"'), ("5", '""', ","),
    ("6", "'", "NULL"), ("7", "n/a", "1e5"),
]
TEXTS = "id string, a string, b string"


def test_csv_brings_texts_back(spark, tmp_path):
    path = str(tmp_path / "texts")
    rows = spark.createDataFrame(HOSTILE, TEXTS)
    files.write_table(rows, path, "csv")
    same(files.read_table(spark, path, "csv", rows.schema), rows)
    inferred = files.read_csv(spark, path, text_columns=["id", "a", "b"], null_mark=files.NULL_MARK)
    same(inferred, rows)


@pytest.mark.parametrize("text", ["two\nlines", "carriage\rreturn", files.NULL_MARK])
def test_csv_refuses_what_it_would_change(spark, tmp_path, text):
    with pytest.raises(Exception, match="CSV cannot hold"):
        files.write_table(spark.createDataFrame([("1", text, "x")], TEXTS), str(tmp_path / "texts"), "csv")


def test_raw_csv_with_line_ends(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = spark.createDataFrame([*HOSTILE, ("8", "two\nlines, \"q\"", "x")], TEXTS)
    files.write_table(rows, path, "csv", line_ends=True)
    same(files.read_csv(spark, path, rows.schema, multi_line=True, null_mark=files.NULL_MARK), rows)


def test_rare_values_are_inferred_from_all_rows(spark, tmp_path):
    path = str(tmp_path / "numbers")
    number = F.when(F.col("id") == 19_999, "2.5").otherwise(F.col("id").cast("string"))
    spark.range(20_000).select(F.format_string("%05d", "id").alias("code"), number.alias("n")).coalesce(1).write.csv(path, header=True)
    read = files.read_csv(spark, path, text_columns=["code"])
    assert dict(read.dtypes) == {"code": "string", "n": "double"}
    assert read.where("n = 2.5").count() == 1 and read.where("code = '00007'").count() == 1


def test_a_foreign_table_is_not_dropped(spark, tmp_path):
    spark.range(3).write.mode("overwrite").saveAsTable("mine")
    spark.range(3).write.parquet(str(tmp_path / "other"))
    with pytest.raises(ValueError, match="not an external table"):
        files.register_table(spark, "mine", str(tmp_path / "other"))
    assert spark.table("mine").count() == 3
    spark.sql("drop table mine")
    for _ in range(2):
        files.register_table(spark, "theirs", str(tmp_path / "other"))
    assert spark.table("theirs").count() == 3
    spark.sql("drop table theirs")


def test_scratch_is_under_the_shared_folder(spark):
    first, second = scratch_root(spark), scratch_root(spark)
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_literal_grades_from_silver(spark, small, layout):
    silver = {e: spark.read.parquet(layout.path("silver", e)).drop("ingest_date") for e in
              ("customers", "loans", "loans_repayments", "loans_defaulters")}
    payments = score.counted_payments(score.payment_base(silver["loans_repayments"], silver["loans"]))
    pairs = score.grade_member_pairs(payments, silver["loans"], silver["customers"], silver["loans_defaulters"], small.hot)
    row = pairs.agg(F.sum("n_rows").alias("n"), F.sum(F.when(F.col("loan_grade").isNull(), F.col("n_rows"))).alias("x"))
    assert tuple(row.first()) == (9_653, 7_937)
