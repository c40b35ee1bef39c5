"""Every query of the credit scoring against its SQL in DuckDB, row for row."""

from __future__ import annotations

from collections import Counter

import pytest

import __spark_entry__ as contract
from conftest import SF_SMALL
from gradewell.plans.oracle import oracle_sql
from gradewell.plans.queries import QUERIES

ORACLE = oracle_sql()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, duck):
    result = QUERIES[name](spark, SF_SMALL)
    columns = sorted(result.columns)
    ours = Counter(repr(tuple(row)) for row in result.select(*columns).collect())
    relation = duck(SF_SMALL).execute(ORACLE[name])
    names = [column[0] for column in relation.description]
    assert sorted(names) == columns
    order = [names.index(column) for column in columns]
    theirs = Counter(repr(tuple(row[i] for i in order)) for row in relation.fetchall())
    assert ours == theirs


def test_entry_is_the_flagship(spark):
    result = contract.entry(spark)
    assert result.columns == ["member_id", "loan_id", "payment_history_pts", "loan_default_history_pts",
                              "financial_health_pts", "loan_total_score", "loan_grade"]
    assert result.count() == 888
