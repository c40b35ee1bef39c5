"""The wide table: customers, loans, repayments, delinquencies and detail records in one row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gradewell.operators.clean import delinquencies_and_details
from gradewell.operators.skew import join_members
from gradewell.schemas import PAIR_COUNT


def member_counts(customers: DataFrame, delinquencies: DataFrame, details: DataFrame) -> DataFrame:
    """How many rows of each table a member has, for members that have some in all three: one row each."""
    sides = {"n_customers": customers, "n_delinq": delinquencies, "n_detail": details}
    ids = [
        df.select("member_id", *[F.lit(int(name == own)).alias(name) for name in sides]) for own, df in sides.items()
    ]
    both = ids[0].unionAll(ids[1]).unionAll(ids[2])
    counted = both.groupBy("member_id").agg(*[F.sum(name).alias(name) for name in sides])
    return counted.where(" and ".join(f"{name} > 0" for name in sides))


def join_wide(customers: DataFrame, loans: DataFrame, repayments: DataFrame, delinquencies: DataFrame,
              details: DataFrame, hot: DataFrame) -> DataFrame:
    """The inner join of the five tables, factored: one row per loan and repayment.

    The join pairs every customer row of a member with every delinquency, detail record and loan of that member, though
    loans say nothing about which belong together. Here each loan carries how many rows of each kind its member has, and
    their product `n_rows`, the rows that the join would make of it; the member's own rows stay in their tables. The
    result is linear in the loans, and no combination is ever made.
    """
    members = member_counts(customers, delinquencies, details)
    return _with_product(join_members(loans.join(repayments, "loan_id"), members, hot))


def join_wide_by_loan(customers: DataFrame, loans: DataFrame, repayments: DataFrame, delinquencies: DataFrame,
                      details: DataFrame, hot: DataFrame) -> DataFrame:
    """The same for loans of which each has an id of its own, as clean.unique_rows() gives them.

    Only the ids of loan and member move to the member, and its counts back to the loan; whole rows stay where loan and
    repayment met.
    """
    members = member_counts(customers, delinquencies, details)
    counts = join_members(loans.select("loan_id", "member_id"), members, hot).drop("member_id")
    counted = loans.join(repayments, "loan_id").join(counts, "loan_id")
    own = [c for c in (*loans.columns, *repayments.columns) if c not in ("loan_id", "member_id")]
    return _with_product(counted.select("member_id", "loan_id", *own, *COUNTS[:3]))


def _with_product(counted: DataFrame) -> DataFrame:
    parts = " * ".join(f"cast({name} as decimal(12,0))" for name in COUNTS[:3])
    return counted.withColumn("n_rows", F.expr(parts).cast(PAIR_COUNT))


def join_kept(customers: DataFrame, loans: DataFrame, repayments: DataFrame, defaulters: DataFrame,
              hot: DataFrame) -> DataFrame:
    """The same join without quarantined members, all columns: one row per loan.

    Each member has one customer and one default-history row, and delinquency and detail record are
    both read off the latter.
    """
    return join_people(loans.join(repayments, "loan_id"), customers, defaulters, hot)


COUNTS = ["n_customers", "n_delinq", "n_detail", "n_rows"]


def kept_of_counted(counted: DataFrame, customers: DataFrame, defaulters: DataFrame, hot: DataFrame) -> DataFrame:
    """The rows of join_kept(), made of those that join_wide() made before: loans and repayments need not meet again.

    A member that is kept has one row of each kind, and one that is quarantined has several of some.
    """
    single = counted.where("n_customers = 1 and n_delinq = 1 and n_detail = 1").drop(*COUNTS)
    return join_people(single, customers, defaulters, hot)


def join_people(paid: DataFrame, customers: DataFrame, defaulters: DataFrame, hot: DataFrame) -> DataFrame:
    """Loans that have their repayments, with the customer and default history of their member, one row each."""
    people = customers.join(delinquencies_and_details(defaulters), "member_id")
    return join_members(paid, people, hot)
