"""The five-table join without its rows: classes of equal rows, who holds them, and how often the join repeats them.

Customers, delinquencies and detail records meet the loans on the member only, so the join of a member's tables is every
combination of their rows. What it says is in its factors: the distinct rows of each table, each kept once however many members
and rows share it (a class, with counts), and a membership table that tells which member holds which class how
often. Any part of the join is made of these by expand().
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from gradewell.functions.keys import injective_text
from gradewell.operators import pairs
from gradewell.operators.skew import SLICE_ROWS, hot_buckets, join_members
from gradewell.operators.wide import member_counts
from gradewell.schemas import PAIR_COUNT

KINDS = ("customers", "delinq", "detail")


def class_id(columns: list[str]) -> Column:
    """The number of a class: a hash of its values in which NULLs and lengths count, so equal values alone share it."""
    return F.md5(injective_text(columns))


def _product(counts: list[str]) -> Column:
    return F.expr(" * ".join(f"cast({c} as decimal(38,0))" for c in counts)).cast(PAIR_COUNT)


@dataclass(frozen=True)
class Factored:
    """The classes of each kind, and who holds them: (kind, member_id, class_id, copies)."""

    classes: dict[str, DataFrame]
    membership: DataFrame


def member_totals(customers: DataFrame, loans: DataFrame, repayments: DataFrame, delinquencies: DataFrame,
                  details: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """For members that have rows in all tables: how many in each, and their pairs of a loan and a repayment of one id."""
    # All columns tell the loans of an id apart, so that salts deal them out.
    paid = pairs.with_repayment_counts(loans, repayments, slice_rows, keep=["loan_id", "member_id"])
    n_pairs = paid.groupBy("member_id").agg(
        F.sum(F.col("n_repayments").cast("decimal(19,0)")).cast(PAIR_COUNT).alias("n_pairs"))
    return member_counts(customers, delinquencies, details).join(n_pairs, "member_id")


def factor(customers: DataFrame, delinquencies: DataFrame, details: DataFrame, totals: DataFrame, hot: DataFrame) -> Factored:
    """The join in factors, by member_totals(); members without a row in each of the five tables are in none of them.

    `n_members` of a class counts the members that hold it, `n_copies` their rows of it, `n_rows` the rows that the join
    makes with it. All is linear in the tables: no two rows of one member are ever paired.
    """
    classes, held = {}, []
    for kind, table in zip(KINDS, (customers, delinquencies, details)):
        values = [c for c in table.columns if c != "member_id"]
        rows = table.groupBy("member_id", *values).agg(F.count("*").alias("copies"))
        counted = join_members(rows, totals, hot).withColumns({
            "class_id": class_id(values),
            "_n_rows": _product(["copies", "n_pairs", *(f"n_{k}" for k in KINDS if k != kind)]),
        })
        classes[kind] = counted.groupBy("class_id", *values).agg(
            F.count("*").alias("n_members"), F.sum("copies").alias("n_copies"), F.sum("_n_rows").cast(PAIR_COUNT).alias("n_rows"))
        held.append(counted.select(F.lit(kind).alias("kind"), "member_id", "class_id", "copies"))
    return Factored(classes, reduce(DataFrame.unionByName, held))


def expand(factored: Factored, loans: DataFrame, repayments: DataFrame, hot: DataFrame, members: DataFrame | None = None,
           slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The rows of the join with all columns, each different one once, and `n_rows`, how often the join has it.

    `members` (member_id) asks for some members; without it all are expanded, which makes as many rows as the join has
    different ones. The rows asked for are the work: nothing is made of other members.
    """
    membership = factored.membership
    if members is not None:
        asked = members.select("member_id").distinct()
        membership = membership.join(asked, "member_id", "left_semi")
        loans = loans.join(asked, "member_id", "left_semi")
        repayments = repayments.join(loans.select("loan_id").distinct(), "loan_id", "left_semi")
    people = None
    for kind in KINDS:
        values = factored.classes[kind].drop("n_members", "n_copies", "n_rows")
        mine = membership.where(F.col("kind") == kind).select("member_id", "class_id", F.col("copies").alias(f"_{kind}"))
        rows = mine.join(values, "class_id").drop("class_id")
        people = rows if people is None else people.join(rows, "member_id")
    # Repayments come last: where ids stand on several of them, the pairs are many more than the loans, and move no more.
    own = pairs.classes(loans, [c for c in loans.columns if c != "loan_id"], "_loans")
    paid = pairs.classes(repayments, [c for c in repayments.columns if c != "loan_id"], "_repayments")
    owners = join_members(own, people, hot)
    met = join_members(owners, paid, hot_buckets(loans.select("loan_id"), "loan_id", slice_rows), key="loan_id")
    counts = ["_loans", "_repayments", *(f"_{kind}" for kind in KINDS)]
    tables = [own, paid.drop("loan_id"), people.drop("member_id")]
    columns = ["member_id", *(c for table in tables for c in table.columns if c not in ("member_id", *counts))]
    return met.withColumn("n_rows", _product(counts)).select(*columns, "n_rows")
