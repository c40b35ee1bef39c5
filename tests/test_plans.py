"""Properties of the plans that matter at scale."""

from __future__ import annotations

import re

import pytest

from conftest import SF_SMALL
from gradewell.operators import clean
from gradewell.operators.split import split_repayments
from gradewell.plans.queries import QUERIES
from gradewell.plans.tables import Tables

# Some write when they are called; one has a session of its own.
NOT_HERE = {"csv_inferred_scan", "csv_declared_scan", "csv_permissive", "csv_sink_roundtrip", "medallion_layout",
            "medallion_literal", "score_from_conf", "csv_by_header_scan", "csv_bad_cells", "csv_good_cells", "scores_of_years",
            "scores_year_replaced", "payment_base_bucketed", "member_points_bucketed", "published_generation",
            "dropped_rows_observed"}


@pytest.fixture(autouse=True, scope="module")
def long_metadata(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def physical(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def shuffled(spark):
    """Plans as they are when no side is small enough to broadcast."""
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield {name: physical(QUERIES[name](spark, SF_SMALL)) for name in sorted(set(QUERIES) - NOT_HERE)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)


def test_no_python_no_cross_join(shuffled):
    for name, plan in shuffled.items():
        for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "ObjectHashAggregate"):
            assert operator not in plan, (name, operator)
        for line in plan.splitlines():
            assert "SortAggregate" not in line or "SortAggregate(key=[loan_id#" in line, (name, line)


def test_only_the_histogram_is_broadcast(shuffled):
    for name, plan in shuffled.items():
        for line in plan.splitlines():
            if "BroadcastHashJoin" in line:
                assert "_bucket" in line, (name, line)


def test_member_joins_run_on_member_and_salt(shuffled):
    for name in ("loan_grade", "exclude_customers", "score_last_payment", "join_wide"):
        assert re.search(r"SortMergeJoin \[member_id#\d+, _salt#\d+\]", shuffled[name]), name


def test_loans_and_repayments_move_once_to_meet(shuffled):
    """Removing copies, finding repeated ids and the join share one shuffle of either side."""
    plan = shuffled["payment_base"]
    moved = [line for line in plan.splitlines() if re.search(r"Exchange hashpartitioning\(loan_id#\d+", line)]
    assert len(moved) == 2
    assert not re.search(r"hashpartitioning\(loan_id#\d+, [a-z]", plan)


def test_loans_are_joined_with_members_once(shuffled):
    joins = [line for line in shuffled["loan_grade"].splitlines() if "SortMergeJoin" in line and "_salt" in line]
    assert len(joins) == 1


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "loans")
    Tables.of(spark, SF_SMALL).landed("loans").write.parquet(path)
    plan = physical(clean.clean_loans(spark.read.parquet(path)))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    for column in clean.REQUIRED_LOAN_COLUMNS:
        assert f"IsNotNull({column})" in pushed


def test_scan_reads_only_the_columns_used(spark, tmp_path):
    path = str(tmp_path / "wide")
    Tables.of(spark, SF_SMALL).keyed.write.parquet(path)
    plan = physical(clean.clean_repayments(split_repayments(spark.read.parquet(path))))
    read = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert len(read.split(":")) - 1 == 8
