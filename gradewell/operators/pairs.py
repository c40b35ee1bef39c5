"""Repayments with their loans where a loan id stands on several rows of either: the many-to-many join in factored form.

Every repayment of an id meets every loan of that id. A placeholder id on a third of all rows would make the square of
that many pairs, though few of them differ in what is asked of them. Each side is therefore cut down to classes, the
distinct values that matter with the number of rows that have them; classes meet, and counts are multiplied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gradewell.operators.score import DEFAULTS, PAYMENT_POINTS, last_payment_points, total_payment_points
from gradewell.operators.skew import SLICE_ROWS, hot_buckets, join_members
from gradewell.params import LITERAL, RuleSet, ScoreParams
from gradewell.schemas import PAIR_COUNT

#: What the payment rules read on either side.
LOAN_VALUES = ["monthly_installment", "funded_amount"]
REPAYMENT_VALUES = ["last_payment_amount", "total_payment_received"]


def classes(rows: DataFrame, columns: list[str], count: str = "copies") -> DataFrame:
    """The distinct values of `columns` among rows with a loan id, and how many rows have them."""
    return rows.where("loan_id is not null").groupBy("loan_id", *columns).agg(F.count("*").alias(count))


def _product(*counts: str) -> Column:
    """A product of counts as a decimal: that of a large id can pass the range of a long."""
    return F.expr(" * ".join(f"cast({c} as decimal(38,0))" for c in counts)).cast(PAIR_COUNT)


def repayments_per_loan_id(repayments: DataFrame) -> DataFrame:
    return repayments.where("loan_id is not null").groupBy("loan_id").agg(F.count("*").alias("n_repayments"))


def with_repayment_counts(loans: DataFrame, repayments: DataFrame, slice_rows: int = SLICE_ROWS,
                          keep: list[str] | None = None) -> DataFrame:
    """Each loan that has repayments, with how many: the factored form of the join. Loans should be distinct rows.

    `keep` names the columns asked for, the loan id among them.
    """
    hot = hot_buckets(loans.select("loan_id"), "loan_id", slice_rows)
    return join_members(loans, repayments_per_loan_id(repayments), hot, key="loan_id", keep=keep)


def expanded(repayments: DataFrame, loans: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """All columns: each pair of a distinct repayment and a distinct loan of one id, with `n_pairs`, how often it occurs.

    As many rows as the join has different ones; what it repeats is counted. Loans of one id are salted, so a placeholder id is
    spread over tasks, and its repayments are sent to each.
    """
    own = classes(loans, [c for c in loans.columns if c != "loan_id"], "_loans")
    paid = classes(repayments, [c for c in repayments.columns if c != "loan_id"], "_repayments")
    met = join_members(own, paid, hot_buckets(own, "loan_id", slice_rows), key="loan_id")
    return met.withColumn("n_pairs", _product("_loans", "_repayments")).drop("_loans", "_repayments")


def payment_pairs(repayments: DataFrame, loans: DataFrame, params: ScoreParams = DEFAULTS, rules: RuleSet = LITERAL,
                  slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Payments of each member by their points, over all pairs of a repayment and a loan of one id.

    First the classes of either side meet, within one id, and give points; the pairs of a loan class shrink to one row for
    each combination of points, at most 18. Only then do the members that hold loans of the class come in.
    """
    key = ["loan_id", *LOAN_VALUES]
    held = loans.where("loan_id is not null")
    # Counted, so that the classes and the hot ones among them come out of one shuffle.
    kinds = held.groupBy(*key).agg(F.count("*").alias("_rows")).where("_rows > 0")
    paid = classes(repayments, REPAYMENT_VALUES, "_repayments")
    met = join_members(paid, kinds.drop("_rows"), hot_buckets(paid, "loan_id", slice_rows), key="loan_id")
    pointed = met.select(
        "loan_id", *LOAN_VALUES, "_repayments",
        last_payment_points(params, rules).alias("last_payment_pts"),
        total_payment_points(params).alias("total_payment_received_pts"),
    )
    counted = pointed.groupBy(*key, *PAYMENT_POINTS).agg(F.sum("_repayments").alias("_repayments"))
    # All columns tell the loans of a class apart, so that salts deal them out.
    of_members = join_members(held, counted, hot_buckets(held, key, slice_rows), key=key, keep=[*key, "member_id"])
    return of_members.groupBy("member_id", *PAYMENT_POINTS).agg(
        F.sum(F.col("_repayments").cast("decimal(19,0)")).cast(PAIR_COUNT).alias("n_payments"))
