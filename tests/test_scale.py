"""What a step moves, on plans as they are when no side is small enough to broadcast, and the packed ids that move."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from gradewell.functions.keys import with_packed_members, with_unpacked_members
from gradewell.operators import factored, pairs, quality, skew, wide
from gradewell.operators.skew import hot_buckets, join_members
from gradewell.plans import queries
from gradewell.plans.tables import Tables
from gradewell.sources import files
from test_medallion import same


@pytest.fixture(autouse=True, scope="module")
def shuffling(spark):
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def small(spark):
    return Tables.of(spark, SF_SMALL)


def physical(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def exchanges(frame) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", physical(frame))


def test_loans_are_not_counted_with_their_member_before_they_are_paired(spark):
    """They move by their class to meet its payments, and only then by their member."""
    loans = spark.createDataFrame([("1", "m", 10, 100), ("1", "m", 10, 100), ("1", "n", 10, 100), (None, "n", 10, 100)],
                                  "loan_id string, member_id string, monthly_installment int, funded_amount int")
    paid = spark.createDataFrame([("1", 5, 50), ("1", 5, 50), ("1", 20, 50)],
                                 "loan_id string, last_payment_amount int, total_payment_received int")
    counted = pairs.payment_pairs(paid, loans)
    per_member = {m: n for m, n in counted.groupBy("member_id").agg(F.sum("n_payments").cast("int")).collect()}
    assert per_member == {"m": 6, "n": 3}
    assert len([keys for keys in exchanges(counted) if "member_id" in keys]) == 1


def test_gold_rows_need_no_second_meeting_of_loans_and_repayments(small):
    counted = wide.join_wide(small.customers, small.unique_loans, small.unique_repayments, small.delinquencies, small.details, small.hot)
    kept = quality.exclude(small.defaulters, small.bad, small.hot)
    customers = quality.exclude(small.customers, small.bad, small.hot)
    same(wide.kept_of_counted(counted, customers, kept, small.hot),
         wide.join_kept(customers, small.unique_loans, small.unique_repayments, kept, small.hot))


def test_whole_rows_do_not_move_to_find_repeated_ids(spark):
    loans = spark.createDataFrame([("1", "x", None), ("1", "x", None), ("2", "x", None), ("2", None, "x"), (None, "a", "b")],
                                  "loan_id string, loan_status string, loan_title string")
    paid = spark.createDataFrame([("1", 1), ("3", 1), ("3", 2), ("3", 2)], "loan_id string, amount int")
    listed = quality.repeated_loans(loans, paid)
    assert sorted(map(tuple, listed.collect())) == [("2", 2, 0), ("3", 0, 2)]
    assert not any("loan_status" in keys for keys in exchanges(listed))


def test_rows_of_ids_on_one_row_a_side_are_not_compared(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("loan_id"), F.lit("x").alias("status"))
    loans = rows.unionAll(spark.sql("select '7', 'y'"))
    assert [side.count() for side in quality._of_ids_on_several_rows(loans, rows)] == [2, 1]


def test_whole_rows_do_not_move_to_the_member_to_be_counted(small):
    sides = (small.customers, small.unique_loans, small.unique_repayments, small.delinquencies, small.details, small.hot)
    by_loan = wide.join_wide_by_loan(*sides)
    same(by_loan, wide.join_wide(*sides))
    assert by_loan.columns == wide.join_wide(*sides).columns
    assert re.search(r"SortMergeJoin \[([a-z_]+)#", physical(by_loan)).group(1) == "loan_id"


def test_members_are_counted_one_by_one_in_large_groups_only(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") < 5_000, "hot").otherwise(F.col("id").cast("string")).alias("m"))
    few = skew._of_large_groups(rows, ["m"], 1_000)
    assert 5_000 <= few.count() < 6_000
    assert few.where("m = 'hot'").count() == 5_000


def test_hot_members_are_found_through_groups(spark, monkeypatch):
    rows = spark.range(300).select(F.when(F.col("id") < 90, "hot").otherwise(F.col("id").cast("string")).alias("m"))
    plain = hot_buckets(rows, "m", 40)
    monkeypatch.setattr(skew, "SLICE_ROWS", 40)
    same(hot_buckets(rows, "m", 40), plain)
    assert plain.count() == 1 and plain.first()["_salts"] == 3


def test_what_tells_the_salt_does_not_move(spark):
    rows = spark.range(200).select(F.lit("hot").alias("m"), F.col("id").alias("loan"), F.lit("wide").alias("text"))
    members = spark.sql("select 'hot' m, 1 n")
    hot = hot_buckets(rows, "m", 10)
    met = join_members(rows, members, hot, key="m", keep=["m", "loan"])
    assert met.columns == ["m", "loan", "n"] and met.count() == 200
    same(met, join_members(rows, members, hot, key="m").drop("text"))


IDS = ["a" * 64, "A" * 64, "0" * 64, "0" * 31, "", None, "x", "a" * 64 + "\n", "é" * 31]


def test_packed_ids_come_back_and_stay_apart(spark):
    ids = spark.createDataFrame([(i,) for i in IDS], "member_id string")
    packed = with_packed_members(ids)
    assert packed.distinct().count() == len(IDS)
    assert packed.agg(F.min(F.octet_length("member_id"))).first()[0] == 32
    same(with_unpacked_members(packed), ids)


def test_tables_are_written_with_zstd(spark, tmp_path):
    files.write_table(spark.range(3), str(tmp_path / "t"))
    assert list((tmp_path / "t").glob("*.zstd.parquet"))


def test_members_beside_a_hot_one_are_not_repeated(spark):
    """A hot member's salts repeat the few members that share its bucket, not a 65,536th of all."""
    rows = spark.range(20_000).select(F.lit("hot").alias("member_id"), F.col("id").alias("loan"))
    members = spark.range(400_000).select(F.concat(F.lit("m"), "id").alias("member_id")).unionAll(spark.sql("select 'hot'"))
    hot = hot_buckets(rows, "member_id", slice_rows=100)
    per_member = join_members(members, members, hot, "left")
    assert per_member.count() == 400_001
    beside = members.join(hot, F.expr("pmod(xxhash64(member_id), 65536) = _bucket % 65536")).count()
    marked = members.join(hot, F.pmod(F.xxhash64("member_id"), F.lit(4_194_304)) == F.col("_bucket")).count()
    assert beside > 3 and marked <= 3


def test_applications_of_one_person_are_dealt_out(spark, monkeypatch):
    plain = queries.skewed_applications(spark, SF_SMALL)
    monkeypatch.setattr(queries, "WIDE_SLICE", 10)
    sliced = queries.skewed_applications(spark, SF_SMALL)
    assert re.search(r"SortMergeJoin \[_of#\d+, _salt#\d+\]", physical(sliced))
    same(sliced, plain)


def test_pairs_do_not_move_after_they_are_made(spark):
    """Repayments are joined last, so the many pairs of repeated ids are written where they are made."""
    t = queries._repeated_ids(spark, SF_SMALL)
    plan = physical(factored.expand(t.factored, t.loans, t.repayments, t.hot, slice_rows=t.slice_rows))
    assert re.search(r"SortMergeJoin \[([a-z_]+)#", plan).group(1) == "loan_id"


@pytest.mark.parametrize("name, scans", [("join_wide_expanded", 0), ("join_wide_expanded_repeated", 0),
                                         ("loan_grade_literal_repeated", 1)])
def test_clean_tables_are_made_once(spark, name, scans):
    """Steps read what was written; customers, of which one step reads few columns, are made as they are read."""
    plan = physical(queries.QUERIES[name](spark, SF_SMALL))
    assert len(re.findall(r"Scan parquet .*orders.parquet", plan)) == scans
