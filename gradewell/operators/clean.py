"""Clean each landed entity table: one function per table, DataFrame in, DataFrame out.

Every table is de-duplicated as landed, before any value changes. `distinct` groups on the whole
row and combines on the map side, so neither a person nor a set of exact copies that holds a large
part of the rows ends up in one task.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from gradewell.functions.text import digits_as_int, months_to_years, whole
from gradewell.schemas import DROPPED_ROWS, MONEY

# The purposes kept; any other becomes "other".
LOAN_PURPOSES = [
    "debt_consolidation", "credit_card", "home_improvement", "other", "major_purchase",
    "medical", "small_business", "car", "vacation", "moving", "house", "wedding",
    "renewable_energy", "educational",
]

# A loan or repayment with a NULL in one of these is dropped.
REQUIRED_LOAN_COLUMNS = [
    "loan_amount", "funded_amount", "loan_term_months", "interest_rate", "monthly_installment",
    "issue_date", "loan_status", "loan_purpose",
]
REQUIRED_REPAYMENT_COLUMNS = [
    "total_principal_received", "total_interest_received", "total_late_fee_received",
    "total_payment_received", "last_payment_amount",
]

REQUIRED = {
    "customers": ["annual_inc"],
    "loans": REQUIRED_LOAN_COLUMNS,
    "loans_repayments": REQUIRED_REPAYMENT_COLUMNS,
}


def dedupe(landed: DataFrame) -> DataFrame:
    return landed.distinct()


def unique_rows(table: DataFrame, key: str) -> DataFrame:
    """The rows whose key stands on one row, or on equal ones, which become one. Rows without a key go.

    One aggregate on the key, combined on the map side, so a key that a third of the rows carry is a row per map
    task; its partitioning and order serve the join that follows. Keys on different rows are what quality.repeated_loans() counts.
    """
    row = F.struct(*[c for c in table.columns if c != key])
    ends = table.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(row).alias("_lo"), F.max(row).alias("_hi"))
    return ends.where("_lo <=> _hi").select(*[F.col(key) if c == key else F.col(f"_lo.{c}").alias(c) for c in table.columns])


def add_ingest_date(df: DataFrame, batch_time: datetime | str) -> DataFrame:
    """Stamp rows with the time of the batch, given by the caller so that reruns agree."""
    return df.withColumn("ingest_date", F.lit(batch_time).cast("timestamp"))


def _require(df: DataFrame, columns: list[str]) -> DataFrame:
    # Conjuncts, unlike na.drop, are pushed into the Parquet scan. Decimals have no NaN.
    return df.where(" and ".join(f"{c} is not null" for c in columns))


def _first_missing(entity: str) -> Column:
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED[entity]])


def _known(landed: DataFrame, entity: str, drops: Observation | None) -> DataFrame:
    """Distinct rows without a NULL in a required column; `drops` counts the others while the result is written."""
    distinct = dedupe(landed)
    if drops is not None:
        first = _first_missing(entity)
        distinct = distinct.observe(drops, *[F.count_if(first == c).alias(c) for c in REQUIRED[entity]])
    return _require(distinct, REQUIRED[entity])


def observed_drops(spark: SparkSession, drops: dict[str, Observation]) -> DataFrame:
    """What dropped_rows() tells, of tables that were written with their cleaner's `drops`: one number per required column.

    The counts were taken in the tasks that wrote, after the shuffle that removes copies, so no row is counted again.
    """
    rows = [(entity, column, n) for entity, seen in drops.items() for column, n in seen.get.items() if n]
    return spark.createDataFrame(rows, DROPPED_ROWS)


def dropped_rows(landed: DataFrame, entity: str) -> DataFrame:
    """How many distinct landed rows the cleaner drops, by the first required column that is missing."""
    missing = dedupe(landed).select(_first_missing(entity).alias("missing")).where("missing is not null")
    return missing.groupBy("missing").agg(F.count("*").alias("n_rows")).select(F.lit(entity).alias("entity"), "missing", "n_rows")


def fill_with_mean(df: DataFrame, column: str, of: DataFrame | None = None) -> DataFrame:
    """Fill NULLs of an int column with its mean (in `of`, the same rows), truncated, as a scalar subquery in the plan."""
    mean = (df if of is None else of).agg(F.avg(column).cast("int")).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), mean))


def _customer_values(known: DataFrame) -> DataFrame:
    return (
        known.withColumnsRenamed({
            "annual_inc": "annual_income",
            "addr_state": "address_state",
            "zip_code": "address_zipcode",
            "country": "address_country",
            "tot_hi_cred_lim": "total_high_credit_limit",
            "annual_inc_joint": "join_annual_income",
        })
        .withColumns({
            "emp_length": digits_as_int(F.col("emp_length")),
            "address_state": F.when(F.length("address_state") > 2, F.lit("NA")).otherwise(F.col("address_state")),
        })
    )


def clean_customers(landed: DataFrame, drops: Observation | None = None) -> DataFrame:
    if drops is None:
        return fill_with_mean(_customer_values(_known(landed, "customers", None)), "emp_length")
    # The mean is taken of unobserved rows, or they would be counted twice. No filter tells the known ones, as it would be
    # pushed below the shuffle that removes copies, which the observed rows would then not share.
    every = _customer_values(dedupe(landed))
    of_known = every.select(F.when(F.col("annual_income").isNotNull(), F.col("emp_length")).alias("emp_length"))
    return fill_with_mean(_customer_values(_known(landed, "customers", drops)), "emp_length", of_known)


def _loan_values(loans: DataFrame) -> DataFrame:
    return loans.withColumns({
        "loan_term_months": months_to_years(F.col("loan_term_months")),
        "loan_purpose": F.when(F.col("loan_purpose").isin(LOAN_PURPOSES), F.col("loan_purpose")).otherwise(F.lit("other")),
    }).withColumnRenamed("loan_term_months", "loan_term_years")


def clean_loans(landed: DataFrame, drops: Observation | None = None) -> DataFrame:
    return _loan_values(_known(landed, "loans", drops))


def unique_loans(landed: DataFrame) -> DataFrame:
    """The clean loans whose id stands on one of them, ready to be joined on it. Clean values decide what is equal."""
    return unique_rows(_loan_values(_require(landed, REQUIRED_LOAN_COLUMNS)), "loan_id")


def _repayment_values(repayments: DataFrame) -> DataFrame:
    parts = F.col("total_principal_received") + F.col("total_interest_received") + F.col("total_late_fee_received")
    unsummed = (F.col("total_principal_received") != 0) & (F.col("total_payment_received") == 0)
    return repayments.withColumns({
        "total_payment_received": F.when(unsummed, parts.cast(MONEY)).otherwise(F.col("total_payment_received")),
        "last_payment_date": F.nullif(F.col("last_payment_date"), F.lit("0.0")),
        "next_payment_date": F.nullif(F.col("next_payment_date"), F.lit("0.0")),
    })


def clean_repayments(landed: DataFrame, drops: Observation | None = None) -> DataFrame:
    return _repayment_values(_known(landed, "loans_repayments", drops))


def unique_repayments(landed: DataFrame) -> DataFrame:
    """The clean repayments whose loan id stands on one of them, ready to be joined on it."""
    return unique_rows(_repayment_values(_require(landed, REQUIRED_REPAYMENT_COLUMNS)), "loan_id")


def count_or_zero(column: str) -> Column:
    return F.coalesce(whole(F.col(column)), F.lit(0))


def clean_defaulters(landed: DataFrame) -> DataFrame:
    return dedupe(landed).withColumn("delinq_2yrs", count_or_zero("delinq_2yrs"))


# Counts of which one above zero makes a delinquency, or a record or enquiry.
DELINQUENCY_COUNTS = ["delinq_2yrs", "mths_since_last_delinq"]
RECORD_COUNTS = ["pub_rec", "pub_rec_bankruptcies", "inq_last_6mths"]


def any_positive(columns: list[str]) -> Column:
    return F.expr(" or ".join(f"{c} > 0" for c in columns))


def _delinquency_columns() -> list[Column]:
    months = whole(F.col("mths_since_last_delinq")).alias("mths_since_last_delinq")
    return [F.col("delinq_2yrs"), F.col("delinq_amnt"), months]


def _detail_columns() -> list[Column]:
    return [count_or_zero(c).alias(c) for c in RECORD_COUNTS]


def delinquencies(defaulters: DataFrame) -> DataFrame:
    return defaulters.where(any_positive(DELINQUENCY_COUNTS)).select("member_id", *_delinquency_columns())


def records_and_enquiries(defaulters: DataFrame) -> DataFrame:
    return defaulters.where(any_positive(RECORD_COUNTS))


def detail_records(defaulters: DataFrame) -> DataFrame:
    return defaulters.select("member_id", *_detail_columns())


def delinquencies_and_details(defaulters: DataFrame) -> DataFrame:
    """Both side by side, for members with one row each."""
    delinquent = defaulters.where(any_positive(DELINQUENCY_COUNTS))
    return delinquent.select("member_id", *_delinquency_columns(), *_detail_columns())


CLEANERS = {
    "customers": clean_customers,
    "loans": clean_loans,
    "loans_repayments": clean_repayments,
    "loans_defaulters": clean_defaulters,
}
