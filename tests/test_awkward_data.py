"""Queries against SQL on random applications full of NULLs, copies, shared persons and odd values."""

from __future__ import annotations

import random
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

from pyspark.sql import functions as F

from gradewell import schemas
from gradewell.operators import pairs, quality
from gradewell.plans import oracle, queries
from gradewell.plans.tables import Tables

MONEY = [None, "0", "0.01", "49.99", "50", "100", "150", "1000", "12000000"]
VALUES = {
    "emp_title": [None, "a", "b||c"], "emp_length": [None, "n/a", "< 1 year", "10+ years", "7 years"],
    "home_ownership": [None, "OWN", "Rent", "MORTGAGE", "ANY", "OTHER", "owner"],
    "annual_inc": [None, "0", "55000", "12000000.5"], "addr_state": [None, "", "CA", "Unknown"],
    "zip_code": ["1"], "grade": [None, "A", "B", "E", "G"], "sub_grade": [None, "A1", "A5", "B2", "E9", "E3"],
    "verification_status": ["v"], "tot_hi_cred_lim": MONEY, "application_type": ["Individual", "Joint App"],
    "term": [None, " 36 months", "60 months", " 7 months"], "issue_d": [None, "Jan-2010"],
    "loan_status": [None, "Current", "FULLY PAID", "Late (31-120 days)", "Late (31 - 120 days)", "Default", "Issued"],
    "purpose": [None, "car", "yacht", ""], "title": [None, 'a "quoted", title'],
    "last_pymnt_d": [None, "0.0", "0", "Jan-2010"], "next_pymnt_d": [None, "0.0", "Jan-2010"],
}
COUNTS = [None, "0", "1", "2", "3", "5", "6", "2.5"]


def value(field, draw):
    choices = VALUES.get(field.name)
    if choices is None:
        choices = COUNTS if field.dataType == schemas.COUNT else MONEY
    chosen = draw.choice(choices)
    return chosen if chosen is None or field.dataType == schemas.TEXT else Decimal(chosen)


def random_applications(spark, seed):
    """300 applications of few persons; some are exact copies, some have no id, some share one of two."""
    draw = random.Random(seed)
    person_fields = [f for f in schemas.WIDE if f.name in schemas.KEY_COLUMNS]
    other = [f for f in schemas.WIDE if f.name not in schemas.KEY_COLUMNS]
    people = [{f.name: value(f, draw) for f in person_fields} for _ in range(60)] + [dict.fromkeys(schemas.KEY_COLUMNS)]
    histories = [{f.name: value(f, draw) for f in other} for _ in people]
    rows = []
    for i in range(300):
        who = draw.randrange(len(people)) if draw.random() < 0.67 else 0
        row = people[who] | {f.name: value(f, draw) for f in other}
        if draw.random() < 0.8:
            loan_part = {n: row[n] for n in ("loan_status", "funded_amnt", "last_pymnt_amnt", "total_pymnt")}
            row |= histories[who] | {k: v for k, v in loan_part.items() if v is not None}
            row |= {n: Decimal(100) for n in ("loan_amnt", "installment", "total_rec_prncp", "total_rec_int")}
            row |= {"int_rate": Decimal(5), "term": " 36 months", "issue_d": "Jan-2010", "purpose": "car",
                    "funded_amnt": row["funded_amnt"] or Decimal(50), "loan_status": row["loan_status"] or "Current",
                    "total_rec_late_fee": Decimal(0), "total_pymnt": row["total_pymnt"] or Decimal(0)}
        row["int_rate"] = Decimal(5) if row["int_rate"] and row["int_rate"] > 9999 else row["int_rate"]
        row["id"] = draw.choice([None, "n/a", "n/a", "dup"]) if draw.random() < 0.1 else str(i)
        rows.append(row)
    rows += [dict(draw.choice(rows)) for _ in range(40)]
    return spark.createDataFrame([tuple(r[n] for n in schemas.WIDE.fieldNames()) for r in rows], schemas.WIDE)


PLANS = {
    "member_id_hash": lambda t: t.keyed.select("id", "member_id"),
    "clean_customers": lambda t: t.customers,
    "clean_loans": lambda t: t.loans,
    "clean_repayments": lambda t: t.repayments,
    "clean_defaulters": lambda t: t.defaulters,
    "defaulters_delinq": lambda t: t.delinquencies,
    "defaulters_detail": lambda t: t.details,
    "bad_members": lambda t: t.bad,
    "bad_members_union": queries.bad_members_union,
    "exclude_customers": lambda t: quality.exclude(t.customers, t.bad, t.hot),
    "exclude_not_in": lambda t: quality.exclude(queries.payment_base(t), t.bad, t.hot),
    "join_wide": queries.join_wide,
    "join_wide_clean": queries.join_wide_clean,
    "join_wide_expanded": queries.join_wide_expanded,
    "wide_customers_classes": lambda t: t.factored.classes["customers"],
    "wide_delinq_classes": lambda t: t.factored.classes["delinq"],
    "wide_detail_classes": lambda t: t.factored.classes["detail"],
    "wide_membership": lambda t: t.factored.membership,
    "loan_grade": queries.loan_grade,
    "loan_grade_from_wide": lambda t: queries.score.grade(queries.score.score_wide(queries.join_wide_clean(t))),
    "loan_grade_literal": queries.loan_grade_literal,
    "loan_grade_incl_clean": lambda t: queries.score.grade(queries._points(t, include_clean_members=True)),
    "score_custom_params": queries.score_custom_params,
}


@pytest.fixture(scope="module", params=[1, 2, 3])
def awkward(request, spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("wide") / f"{request.param}.parquet")
    random_applications(spark, request.param).coalesce(1).write.parquet(path)
    connection = duckdb.connect()
    connection.execute(f"create view applications_file as select * from '{path}/*.parquet'")
    # Salt whatever is above four rows, so that the salted way is what is compared.
    return Tables(spark.read.parquet(path), slice_rows=4), connection


@pytest.mark.parametrize("name", PLANS)
def test_matches_sql(awkward, name):
    tables, connection = awkward
    start = oracle.STEPS.index("keyed as (")
    sql = "with applications as (select * from applications_file)," + oracle.oracle_sql()[name][start:]
    result = PLANS[name](tables)
    columns = sorted(result.columns)
    ours = Counter(repr(tuple(r)) for r in result.select(*columns).collect())
    relation = connection.execute(sql)
    names = [c[0] for c in relation.description]
    order = [names.index(c) for c in columns]
    theirs = Counter(repr(tuple(r[i] for i in order)) for r in relation.fetchall())
    assert ours == theirs
    if name in ("loan_grade", "loan_grade_literal", "join_wide", "join_wide_expanded", "bad_members"):
        assert ours


def test_all_pairs_of_repeated_ids_match_sql(awkward):
    tables, connection = awkward
    start = oracle.STEPS.index("keyed as (")
    sql = "with applications as (select * from applications_file)," + oracle.STEPS[start:] + "x as (select 1)"
    wanted = connection.execute(sql + " select count(*), max(n) from (select count(*) n from all_pairs group by loan_id)").fetchone()
    expanded = pairs.expanded(tables.repayments, tables.loans, 1)
    by_id = expanded.groupBy("loan_id").agg(F.sum("n_pairs").alias("n"))
    assert tuple(map(int, by_id.agg(F.count("*"), F.max("n")).first())) == wanted
    counted = pairs.payment_pairs(tables.repayments, tables.loans, slice_rows=1).agg(F.sum("n_payments")).first()[0]
    assert counted == connection.execute(sql + " select count(*) from all_pairs").fetchone()[0]
    assert wanted[1] > 1
