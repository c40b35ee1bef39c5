"""What raw files may get wrong, and how layers are laid out, replaced and published."""

from __future__ import annotations

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from gradewell import schemas
from gradewell.operators import clean, quality, score
from gradewell.plans import medallion
from gradewell.plans.queries import BATCH_TIME, DIRTY, QUERIES
from gradewell.plans.tables import Tables
from gradewell.sources import files, generations
from gradewell.sources.applications import read_applications
from gradewell.sources.layout import Layout
from test_medallion import same


@pytest.fixture(scope="module")
def small(spark):
    return Tables.of(spark, SF_SMALL)


@pytest.fixture(scope="module")
def layout(spark, small, tmp_path_factory):
    return medallion.run(spark, small.applications, str(tmp_path_factory.mktemp("lake")), BATCH_TIME)


def physical(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


# --- headers ------------------------------------------------------------------------------------

@pytest.fixture
def two_orders(spark, tmp_path):
    path = str(tmp_path / "two orders")
    spark.createDataFrame([("1", "a,b", "x")], "id string, title string, note string").write.csv(path, header=True)
    other = spark.createDataFrame([("y", "own", "2", 'say "c"')], "note string, `more, of it` string, id string, title string")
    other.write.mode("append").csv(path, header=True, escape='"')
    return path


def test_files_are_read_by_their_own_headers(spark, two_orders):
    read = files.read_csv_by_header(spark, two_orders, ["id", "title", "note"])
    assert sorted(map(tuple, read.collect())) == [("1", "a,b", "x"), ("2", 'say "c"', "y")]
    # Columns that are not asked for may be missing in some files.
    assert sorted(map(tuple, files.read_csv_by_header(spark, two_orders, ["note", "id"]).collect())) == [("x", "1"), ("y", "2")]


def test_a_scan_by_header_parses_the_wanted_columns_only(spark, two_orders):
    plan = physical(files.read_csv_by_header(spark, two_orders, ["id"]))
    assert plan.count("ReadSchema: struct<id:string>") == 2


def test_other_headers_are_refused(spark, two_orders, tmp_path):
    with pytest.raises(ValueError, match="no header"):
        files.read_csv_by_header(spark, two_orders, ["id", "more, of it"])
    twice = str(tmp_path / "twice")
    spark.createDataFrame([("id,title,id",), ("1,2,3",)], "value string").coalesce(1).write.text(twice)
    with pytest.raises(ValueError, match="twice"):
        files.read_csv_by_header(spark, twice, ["id", "title"])
    two = str(tmp_path / "two")
    spark.createDataFrame([("id,title",), ("1,2",), ("title,id",)], "value string").coalesce(1).write.text(two)
    with pytest.raises(ValueError, match="two headers"):
        files.read_csv_by_header(spark, two, ["id", "title"])


def test_positions_decide_only_where_headers_agree(spark, tmp_path):
    path = str(tmp_path / "loans")
    schema = schemas.T.StructType([schemas.LOANS["loan_id"], schemas.LOANS["loan_amount"]])
    spark.createDataFrame([("1", "5.00")], "id string, loan_amnt string").write.csv(path, header=True)
    read = files.read_csv(spark, path, schema, source_names=["id", "loan_amnt"])
    assert [(r["loan_id"], str(r["loan_amount"])) for r in read.collect()] == [("1", "5.00")]
    spark.createDataFrame([("6.00", "2")], "loan_amnt string, id string").write.mode("append").csv(path, header=True)
    with pytest.raises(Exception, match="FAILED_READ_FILE|header"):
        files.read_csv(spark, path, schema, source_names=["id", "loan_amnt"]).collect()
    with pytest.raises(Exception, match="FAILED_READ_FILE|header"):
        files.read_csv(spark, path, schema, source_names=["id", "loan_amnt"]).select("loan_amount").collect()
    with pytest.raises(ValueError):
        files.read_csv(spark, path, schema, source_names=["id"])


# --- cells --------------------------------------------------------------------------------------

def test_each_bad_cell_is_listed_once_and_its_row_survives(spark, tmp_path):
    path = str(tmp_path / "cells")
    lines = ["1,x,2.50", "2,3.00,", "3,nan,1e2", "4,5", "5,6,7,8", '6,"a ""b"", c",9', "7, 8 ,\\N"]
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(path)
    read = files.read_csv_cells(spark, path, DIRTY, header=False, null_mark="\\N")
    rows = {r["loan_id"]: [None if x is None else str(x) for x in (r["loan_amount"], r["monthly_installment"])] for r in read.collect()}
    assert rows == {"1": [None, "2.50"], "2": ["3.00", None], "3": [None, "100.00"], "4": ["5.00", None], "5": ["6.00", "7.00"],
                    "6": [None, "9.00"], "7": ["8.00", None]}
    listed = sorted(map(tuple, files.bad_cells(read, "loan_id").collect()))
    assert listed == [("1", "loan_amount", "x"), ("3", "loan_amount", "nan"), ("4", "_record", "4,5"),
                      ("5", "_record", "5,6,7,8"), ("6", "loan_amount", 'a "b", c')]


def test_a_run_quarantines_bad_cells(spark, small, tmp_path):
    raw = str(tmp_path / "raw")
    text = small.applications.select(*[F.col(c).cast("string").alias(c) for c in small.applications.columns])
    broken = F.col("id").cast("long") % 50 == 1
    dirty = text.withColumn("annual_inc", F.when(broken, F.lit("a lot")).otherwise(F.col("annual_inc")))
    files.write_table(dirty, raw, "csv")
    read = read_applications(spark, raw, null_mark=files.NULL_MARK, keep_bad_cells=True)
    lake = medallion.run(spark, read, str(tmp_path / "lake"), BATCH_TIME)
    listed = lake.read(spark, "quarantine", "bad_cells")
    same(listed, dirty.where(broken).select("id", F.lit("annual_inc").alias("column_name"), F.lit("a lot").alias("cell")))
    assert listed.count() > 0
    # Nothing else changes: the same run on applications whose broken cells are NULL.
    nulls = small.applications.withColumn("annual_inc", F.when(~broken, F.col("annual_inc")))
    same(lake.read(spark, "bronze", "customers"), Tables(nulls).landed("customers"))


# --- repeated loans -----------------------------------------------------------------------------

@pytest.mark.parametrize("column,one,two", [("purpose", "yacht", "boat"), ("term", "36 months", " 36 months")])
def test_loans_that_cleaning_makes_equal_are_one(spark, small, tmp_path, column, one, two):
    """The query, the run and the quarantine decide alike: two rows of one id that clean values do not tell apart are one loan."""
    scored = QUERIES["loan_grade"](spark, SF_SMALL).orderBy("loan_id").first()["loan_id"]
    pair = small.applications.where(F.col("id") == scored)
    rest = small.applications.where(F.col("id") != scored)
    both = pair.withColumn(column, F.lit(one)).unionAll(pair.withColumn(column, F.lit(two)))
    path = str(tmp_path / "wide")
    rest.unionAll(both).write.parquet(path)
    t = Tables(spark.read.parquet(path))
    from gradewell.plans.queries import loan_grade
    in_query = loan_grade(t).where(F.col("loan_id") == scored)
    lake = medallion.run(spark, t.applications, str(tmp_path / "lake"), BATCH_TIME)
    in_run = lake.read(spark, "gold", "loan_scores").drop("ingest_date", "issue_year")
    assert in_query.count() == 1
    same(in_run, loan_grade(t))
    for listed in (lake.read(spark, "quarantine", "repeated_loans"), quality.repeated_loans(t.loans, t.repayments)):
        assert listed.count() == 0
    # A loan that differs in a clean value is listed, and scored by neither.
    more = spark.read.parquet(path).unionAll(pair.withColumn("purpose", F.lit("wedding")))
    t = Tables(more)
    assert [r["loan_id"] for r in quality.repeated_loans(t.loans, t.repayments).collect()] == [scored]
    assert loan_grade(t).where(F.col("loan_id") == scored).count() == 0


def test_members_asked_for_are_expanded(spark, small, layout):
    members = small.customers.select("member_id").where(F.col("member_id") < "2")
    plain = (
        small.customers.join(small.loans, "member_id").join(small.repayments, "loan_id")
        .join(small.delinquencies, "member_id").join(small.details, "member_id").join(members.distinct(), "member_id", "left_semi"))
    counted = plain.groupBy(*plain.columns).agg(F.count("*").cast(schemas.PAIR_COUNT).alias("n_rows"))
    expanded = medallion.expand_wide(spark, layout, members).drop("ingest_date")
    same(expanded, counted)
    assert expanded.agg(F.sum("n_rows")).first()[0] == plain.count() > 0
    assert medallion.expand_wide(spark, layout).agg(F.sum("n_rows")).first()[0] == 4_899


# --- NOT IN -------------------------------------------------------------------------------------

@pytest.mark.parametrize("slice_rows", [1, 1_000_000])
@pytest.mark.parametrize("listed", [[], [None], ["a"], ["a", None], ["a", "a", "z"]])
def test_not_in_by_the_rules_of_null(spark, listed, slice_rows):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(["a", "b", None, "a", "c", None])], "n int, v string")
    names = spark.createDataFrame([(v,) for v in listed], "name string")
    kept = quality.exclude_listed(rows, names, "v", slice_rows)
    assert kept.columns == rows.columns
    same(kept, spark.sql("select * from {rows} where v not in (select name from {names})", rows=rows, names=names))


def test_not_in_shuffles_when_the_list_is_large(spark, small):
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = physical(quality.exclude_listed(small.repayments, small.repayments.select("next_payment_date"), "next_payment_date"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
    assert re.search(r"SortMergeJoin \[next_payment_date#\d+, _salt#\d+\]", plan) and "BroadcastNestedLoopJoin" not in plan


# --- keys ---------------------------------------------------------------------------------------

def test_persons_that_share_an_id_are_told(spark):
    def person(**values):
        return tuple(values.get(f.name) for f in schemas.WIDE)

    rows = [person(id="1", emp_title="x", emp_length="y"), person(id="2", emp_title="x", home_ownership="y"),
            person(id="3", emp_title="x||y"), person(id="4", emp_title="z"), person(id="5", emp_title="z"),
            person(id="6"), person(id="7", emp_title="")]
    t = Tables(spark.createDataFrame(rows, schemas.WIDE))
    shared = {r["member_id"]: r["n_persons"] for r in quality.shared_ids(t.keyed).collect()}
    ids = {r["id"]: r["member_id"] for r in t.keyed.collect()}
    # No value and one empty text share an id as well: the key skips NULLs.
    assert shared == {ids["1"]: 3, ids["6"]: 2} and ids["1"] == ids["2"] == ids["3"]


# --- layout -------------------------------------------------------------------------------------

def test_a_year_is_read_and_replaced_alone(spark, layout):
    one = medallion.issued(layout.read(spark, "gold", "total_files"), [2010])
    assert re.search(r"PartitionFilters: \[[^\]]*issue_year", physical(one))
    before = layout.read(spark, "gold", "loan_scores").where("issue_year <> 2010")
    kept = {tuple(r) for r in before.collect()}
    later = "2025-01-01 00:00:00"
    medallion.score_loans(spark, layout, later, years=[2010])
    after = layout.read(spark, "gold", "loan_scores")
    assert {tuple(r) for r in after.where("issue_year <> 2010").collect()} == kept
    assert {r[0] for r in after.where("issue_year = 2010").select("ingest_date").distinct().collect()} == {datetime(2025, 1, 1)}
    medallion.score_loans(spark, layout, BATCH_TIME)
    assert {r[0] for r in layout.read(spark, "gold", "loan_scores").select("ingest_date").distinct().collect()} == {datetime(2024, 1, 31, 12)}


def test_bucketed_tables_join_without_a_shuffle(spark, layout):
    names = medallion.bucket_silver(spark, layout, "bucketed_test", 8)
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    read = {entity: spark.table(name) for entity, name in names.items()}
    loans, repayments = clean.unique_rows(read["loans"], "loan_id"), clean.unique_rows(read["loans_repayments"].drop("ingest_date"), "loan_id")
    base = score.payment_base(repayments, loans)
    points = score.member_history(read["loans_defaulters"]).join(score.member_profile(read["customers"]), "member_id")
    for frame in (base, points):
        assert "Exchange" not in physical(frame) and "SortMergeJoin" in physical(frame)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
    assert base.count() == QUERIES["payment_base"](spark, SF_SMALL).count()
    spark.sql("drop database bucketed_test cascade")


def test_drops_are_counted_while_writing(spark, layout, tmp_path):
    """Counted after copies are gone, without a shuffle beside those of the writes."""
    from pyspark.sql import Observation

    drops = Observation("drops")
    landed = layout.read(spark, "bronze", "loans")
    cleaned = clean.clean_loans(landed, drops)
    assert physical(cleaned).count("Exchange") == physical(clean.clean_loans(landed)).count("Exchange")
    files.write_table(cleaned, str(tmp_path / "loans"))
    same(clean.observed_drops(spark, {"loans": drops}), clean.dropped_rows(landed, "loans"))


# --- generations --------------------------------------------------------------------------------

def test_a_run_that_dies_leaves_the_old_generation(spark, small, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    assert medallion.current(spark, root) is None
    first = medallion.run_published(spark, small.applications, root, BATCH_TIME)
    scores = first.read(spark, "gold", "loan_scores").count()
    assert medallion.current(spark, root) == first

    def dies(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(medallion, "build_wide", dies)
    with pytest.raises(RuntimeError):
        medallion.run_published(spark, small.applications.limit(10), root, BATCH_TIME)
    assert medallion.current(spark, root) == first
    assert medallion.current(spark, root).read(spark, "gold", "loan_scores").count() == scores


def test_the_last_published_is_current(spark, tmp_path):
    root = str(tmp_path)
    names = [generations.new_generation(root) for _ in range(3)]
    for name in names:
        generations.publish(spark, root, name)
        assert generations.current(spark, root) == name
    generations.publish(spark, root, names[0])
    assert generations.current(spark, root) == names[0]
    assert generations.manifest(spark, root).count() == 4
    assert Layout(names[0]).path("gold", "customers").startswith(names[0])
