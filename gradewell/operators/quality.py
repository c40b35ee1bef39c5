"""Find, quarantine and exclude members whose records conflict."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from gradewell.functions.keys import injective_key, injective_text
from gradewell.operators.clean import DELINQUENCY_COUNTS, any_positive
from gradewell.operators.skew import SLICE_ROWS, hot_buckets, join_members
from gradewell.schemas import KEY_COLUMNS


def duplicate_members(table: DataFrame) -> DataFrame:
    """Members with more than one row, with the number of rows."""
    return table.groupBy("member_id").agg(F.count("*").alias("total")).where(F.col("total") > 1)


def ranked_duplicates(table: DataFrame) -> DataFrame:
    """Report of the duplicate members, most rows first."""
    return duplicate_members(table).orderBy(F.col("total").desc(), "member_id")


def bad_members(customers: DataFrame, defaulters: DataFrame) -> DataFrame:
    """Distinct ids of members that occur more than once among customers, delinquencies or detail records.

    The three counts are taken in one aggregate over the union of the ids, so the set union needs a
    single shuffle, with one combined row per member and map task.
    """
    customer_rows = customers.select("member_id", F.lit(1).alias("c"), F.lit(0).alias("q"), F.lit(0).alias("d"))
    delinquent = F.when(any_positive(DELINQUENCY_COUNTS), 1).otherwise(0)
    default_rows = defaulters.select("member_id", F.lit(0).alias("c"), delinquent.alias("q"), F.lit(1).alias("d"))
    return (
        customer_rows.unionByName(default_rows)
        .groupBy("member_id")
        .agg(F.sum("c").alias("c"), F.sum("q").alias("q"), F.sum("d").alias("d"))
        .where((F.col("c") > 1) | (F.col("q") > 1) | (F.col("d") > 1))
        .select("member_id")
    )


# Ids share as many marks, so that those of the ids to look at can be broadcast at any data size.
_ID_MARKS = 262_144


def _of_ids_on_several_rows(*sides: DataFrame) -> list[DataFrame]:
    """The rows with a loan id whose mark is that of an id on several rows of one side: all that can be repeated, and few others."""
    mark = F.pmod(F.xxhash64("loan_id"), F.lit(_ID_MARKS)).cast("int")
    known = [rows.where("loan_id is not null") for rows in sides]
    ids = reduce(DataFrame.unionAll, [rows.select("loan_id", F.lit(n).alias("_side")) for n, rows in enumerate(known)])
    several = ids.groupBy("loan_id", "_side").agg(F.count("*").alias("_rows")).where("_rows > 1")
    marks = F.broadcast(several.select(mark.alias("_mark")).distinct())
    return [rows.join(marks, mark == F.col("_mark"), "left_semi") for rows in known]


def _digests(rows: DataFrame, loan: bool) -> DataFrame:
    """For each row with a loan id its side and a digest of 16 bytes, which travels in its place."""
    digest = F.unhex(F.md5(injective_text(rows.columns))).alias("_digest")
    return rows.where("loan_id is not null").select("loan_id", F.lit(loan).alias("_loan"), digest)


def repeated_loans(loans: DataFrame, repayments: DataFrame) -> DataFrame:
    """Loan ids on several distinct clean loans or repayments, with how many of each.

    Rows that only cleaning made equal are one, as they are for clean.unique_rows(): what it drops is what is listed here.
    """
    loans, repayments = _of_ids_on_several_rows(loans, repayments)
    counted = _digests(loans, True).unionAll(_digests(repayments, False)).distinct().groupBy("loan_id").agg(
        F.count_if("_loan").alias("n_loans"), F.count_if(~F.col("_loan")).alias("n_repayments"))
    return counted.where("n_loans > 1 or n_repayments > 1")


def union_of_members(*id_lists: DataFrame) -> DataFrame:
    """Distinct union of several id lists, for tables that are at hand separately."""
    union = id_lists[0].select("member_id")
    for ids in id_lists[1:]:
        union = union.unionByName(ids.select("member_id"))
    return union.distinct()


def exclude_listed(rows: DataFrame, listed: DataFrame, column: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Rows whose `column` is NOT IN the only column of `listed`, by the rules of SQL for NULL.

    An empty list excludes nothing. A NULL in the list leaves every comparison unknown, so no row stays. Else rows whose own
    value is NULL go too. Spark's plan for NOT IN broadcasts the whole list; here three facts about it, taken in one
    aggregate, stand in the filter as scalars, and the list itself meets the rows in an anti join that can shuffle. Values that
    very many rows share, NULL among them, are salted; rows should be distinct.
    """
    value = F.col(listed.columns[0])
    facts = listed.agg(F.struct(F.count("*").alias("n"), F.count(value).alias("known")).alias("facts")).scalar()
    empty, no_null = facts["n"] == 0, facts["n"] == facts["known"]
    known = listed.select(value.alias(column)).where(F.col(column).isNotNull()).distinct()
    unlisted = join_members(rows, known, hot_buckets(rows.select(column), column, slice_rows), "left_anti", column)
    return unlisted.where(empty | (no_null & F.col(column).isNotNull())).select(*rows.columns)


def shared_ids(keyed: DataFrame) -> DataFrame:
    """Person ids that different persons share, with how many: the key skips NULLs, an injective key does not."""
    persons = keyed.select("member_id", F.unhex(injective_key(KEY_COLUMNS)).alias("person")).distinct()
    counted = persons.groupBy("member_id").agg(F.count("*").alias("n_persons"))
    return counted.where("n_persons > 1")


def exclude(rows: DataFrame, bad: DataFrame, hot: DataFrame) -> DataFrame:
    """Rows of members that are not in `bad`.

    An anti join: equal to NOT IN because a member id is never NULL, and not bound to a broadcast of `bad`.
    """
    return join_members(rows, bad.select("member_id"), hot, "left_anti")
