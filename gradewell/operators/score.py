"""Score loans: ten rules, three weighted groups, a total and a letter grade.

Rules are computed as early as their columns allow, so that only points travel through the shuffles:
customers and default history become one short row per member, and each loan meets its member in
a single join. A member with more than one customer or default-history row is quarantined, so the
aggregates that build those rows drop such members themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gradewell.functions.bands import band_points, grade_points, letter_grade, pattern_points
from gradewell.operators.clean import DELINQUENCY_COUNTS, RECORD_COUNTS, any_positive, count_or_zero
from gradewell.operators.quality import bad_members, duplicate_members, exclude
from gradewell.operators.skew import join_members
from gradewell.params import GRADE_LEVELS, LITERAL, REPAIRED, TOTAL_PAYMENT_BANDS, RuleSet, ScoreParams
from gradewell.schemas import PAIR_COUNT, SCORE, SUBSCORE

DEFAULTS = ScoreParams()
KEYS = ("member_id", "loan_id")

PAYMENT_POINTS = ["last_payment_pts", "total_payment_received_pts"]
HISTORY_POINTS = ["delinq_pts", "public_record_pts", "public_bankruptcies_pts", "enq_pts"]
HEALTH_POINTS = ["loan_status_pts", "home_pts", "funded_amt_pts", "grade_pts"]
SUBSCORES = ["payment_history_pts", "loan_default_history_pts", "financial_health_pts"]


# --- the rules, one expression each -------------------------------------------------------------

def last_payment_points(params: ScoreParams, rules: RuleSet) -> Column:
    return band_points(rules.last_payment, "last_payment_amount", params, scale="monthly_installment")


def total_payment_points(params: ScoreParams) -> Column:
    return band_points(TOTAL_PAYMENT_BANDS, "total_payment_received", params,
                       scale="funded_amount", otherwise="unacceptable")


def count_points(column: str, params: ScoreParams, rules: RuleSet) -> Column:
    return band_points(rules.counts, column, params, null_test=rules.count_null_column)


def loan_status_points(params: ScoreParams, rules: RuleSet) -> Column:
    return pattern_points(rules.loan_status, "loan_status", params, otherwise=rules.otherwise_status)


def home_points(params: ScoreParams, rules: RuleSet) -> Column:
    return pattern_points(rules.home, "home_ownership", params, otherwise=rules.otherwise_home)


def home_points_of_loan(points: Column, no_status: Column, params: ScoreParams, rules: RuleSet) -> Column:
    """Home points once the loan is known: one profile gives the lowest level to loans without a status."""
    if not rules.home_tests_loan_status:
        return points
    return F.coalesce(points, F.when(no_status, F.lit(params.unacceptable)))


def funded_points(params: ScoreParams, rules: RuleSet) -> Column:
    return band_points(rules.funded, "funded_amount", params,
                       scale="total_high_credit_limit", otherwise=rules.otherwise_funded)


def lender_grade_points(params: ScoreParams, rules: RuleSet) -> Column:
    return grade_points("grade", "sub_grade", GRADE_LEVELS, params, rules.otherwise_grade)


def _weighted(points: list[str], weight) -> Column:
    return F.expr(f"({' + '.join(points)}) * {weight}").cast(SUBSCORE)


def payment_history(params: ScoreParams) -> Column:
    return _weighted(PAYMENT_POINTS, params.payment_weight)


def default_history(params: ScoreParams) -> Column:
    return _weighted(HISTORY_POINTS, params.default_weight)


def financial_health(params: ScoreParams) -> Column:
    return _weighted(HEALTH_POINTS, params.health_weight)


# --- stages -------------------------------------------------------------------------------------

def payment_base(repayments: DataFrame, loans: DataFrame) -> DataFrame:
    """Repayments with their loans."""
    return repayments.join(loans, "loan_id")


def payment_points(base: DataFrame, params: ScoreParams = DEFAULTS, rules: RuleSet = REPAIRED,
                   keep: tuple[str, ...] = KEYS) -> DataFrame:
    """The rules that need only the loan, and the amount that the credit limit is compared with later."""
    return base.select(
        *keep,
        last_payment_points(params, rules).alias("last_payment_pts"),
        total_payment_points(params).alias("total_payment_received_pts"),
        loan_status_points(params, rules).alias("loan_status_pts"),
        "funded_amount",
    )


def member_history(defaulters: DataFrame, params: ScoreParams = DEFAULTS, rules: RuleSet = REPAIRED,
                   include_clean_members: bool = False) -> DataFrame:
    """History rules of each member with exactly one default-history row.

    Delinquencies and detail records are projections of the same rows, so one aggregate serves both.
    Members without a delinquency drop out, as they have no delinquency row to join, unless
    `include_clean_members` scores them as having none.
    """
    delinquent = any_positive(DELINQUENCY_COUNTS)
    counts = ["delinq_2yrs", *RECORD_COUNTS]
    single = (
        defaulters.select(
            "member_id",
            F.when(delinquent, F.col("delinq_2yrs")).alias("delinq_2yrs"),
            *[count_or_zero(c).alias(c) for c in RECORD_COUNTS],
        )
        .groupBy("member_id")
        .agg(F.count("*").alias("_rows"), *[F.max(c).alias(c) for c in counts])
        .where(F.col("_rows") == 1)
    )
    if include_clean_members:
        single = single.withColumn("delinq_2yrs", F.coalesce("delinq_2yrs", F.lit(0)))
    else:
        single = single.where(F.col("delinq_2yrs").isNotNull())
    return single.select(
        "member_id",
        *[count_points(c, params, rules).alias(p) for c, p in zip(counts, HISTORY_POINTS)],
    )


def member_profile(customers: DataFrame, params: ScoreParams = DEFAULTS, rules: RuleSet = REPAIRED) -> DataFrame:
    """Customer rules and credit limit of each member with exactly one customer row."""
    return (
        customers.select(
            "member_id",
            home_points(params, rules).alias("home_pts"),
            lender_grade_points(params, rules).alias("grade_pts"),
            "total_high_credit_limit",
        )
        .groupBy("member_id")
        .agg(
            F.count("*").alias("_rows"),
            *[F.max(c).alias(c) for c in ["home_pts", "grade_pts", "total_high_credit_limit"]],
        )
        .where(F.col("_rows") == 1)
        .drop("_rows")
    )


def _history_of_kept_members(customers: DataFrame, defaulters: DataFrame, *args, **kwargs) -> DataFrame:
    duplicates = duplicate_members(customers).select("member_id")
    return member_history(defaulters, *args, **kwargs).join(duplicates, "member_id", "left_anti")


def score_payments(base: DataFrame, customers: DataFrame, defaulters: DataFrame, hot: DataFrame,
                   params: ScoreParams = DEFAULTS, rules: RuleSet = REPAIRED) -> DataFrame:
    """First group: the loans of members that are not quarantined."""
    points = payment_points(base, params, rules).select("member_id", "loan_id", *PAYMENT_POINTS)
    kept = exclude(points, bad_members(customers, defaulters), hot)
    return kept.withColumn("payment_history_pts", payment_history(params))


def score_history(base: DataFrame, customers: DataFrame, defaulters: DataFrame, hot: DataFrame,
                  params: ScoreParams = DEFAULTS, rules: RuleSet = REPAIRED) -> DataFrame:
    """Second group, for the loans that also have a default history."""
    loans = payment_points(base, params, rules).select("member_id", "loan_id", *PAYMENT_POINTS)
    history = _history_of_kept_members(customers, defaulters, params, rules)
    return join_members(loans, history, hot).withColumn("loan_default_history_pts", default_history(params))


def score_points(base: DataFrame, customers: DataFrame, defaulters: DataFrame, hot: DataFrame,
                 params: ScoreParams = DEFAULTS, rules: RuleSet = REPAIRED,
                 include_clean_members: bool = False, keep: tuple[str, ...] = KEYS) -> DataFrame:
    """All ten rules, one row per loan."""
    members = member_history(defaulters, params, rules, include_clean_members).join(
        member_profile(customers, params, rules), "member_id")
    return (
        join_members(payment_points(base, params, rules, keep), members, hot)
        .withColumn("funded_amt_pts", funded_points(params, rules))
        .select(*keep, *PAYMENT_POINTS, *HISTORY_POINTS, *HEALTH_POINTS)
    )


def score_wide(wide: DataFrame, params: ScoreParams = DEFAULTS, rules: RuleSet = REPAIRED,
               keep: tuple[str, ...] = KEYS) -> DataFrame:
    """All ten rules on rows that already hold everything, such as the wide table without quarantined members."""
    history = zip(["delinq_2yrs", *RECORD_COUNTS], HISTORY_POINTS)
    home = home_points_of_loan(home_points(params, rules), F.col("loan_status").isNull(), params, rules)
    return wide.select(
        *keep,
        last_payment_points(params, rules).alias("last_payment_pts"),
        total_payment_points(params).alias("total_payment_received_pts"),
        *[count_points(column, params, rules).alias(points) for column, points in history],
        loan_status_points(params, rules).alias("loan_status_pts"),
        home.alias("home_pts"),
        funded_points(params, rules).alias("funded_amt_pts"),
        lender_grade_points(params, rules).alias("grade_pts"),
    )


def sub_scores(points: DataFrame, params: ScoreParams = DEFAULTS) -> DataFrame:
    return points.withColumns({
        "payment_history_pts": payment_history(params),
        "loan_default_history_pts": default_history(params),
        "financial_health_pts": financial_health(params),
    })


def total_score(scored: DataFrame) -> DataFrame:
    return scored.withColumn("loan_total_score", F.expr(" + ".join(SUBSCORES)).cast(SCORE))


def grade(points: DataFrame, params: ScoreParams = DEFAULTS, rules: RuleSet = REPAIRED,
          keep: tuple[str, ...] = KEYS) -> DataFrame:
    """Sub-scores, total and letter grade with the keys of the loan."""
    totals = total_score(sub_scores(points, params))
    letter = letter_grade("loan_total_score", params, rules.half_open_grades)
    return totals.select(*keep, *SUBSCORES, "loan_total_score", letter.alias("loan_grade"))


def counted_payments(base: DataFrame, params: ScoreParams = DEFAULTS, rules: RuleSet = LITERAL) -> DataFrame:
    """Payments of each member by their points, of repayments that are joined with their loans already."""
    return payment_points(base, params, rules).groupBy("member_id", *PAYMENT_POINTS).agg(
        F.count("*").cast(PAIR_COUNT).alias("n_payments"))


def grade_member_pairs(payments: DataFrame, loans: DataFrame, customers: DataFrame, defaulters: DataFrame,
                       hot: DataFrame, params: ScoreParams = DEFAULTS, rules: RuleSet = LITERAL) -> DataFrame:
    """The grades when loans are joined a second time on the member instead of the loan.

    That join pairs every payment of a member with every loan of the member. Its output carries no loan,
    so equal rows are given once with `n_rows`, and the pairs are never made: payments and loans are
    first counted per member and points, a bounded number of combinations, then multiplied. `payments` holds those counts
    as `n_payments`, from counted_payments() or, with loan ids on several rows, from pairs.payment_pairs().
    """
    # Members with several customer rows have no profile, so they fall out when both sides meet.
    histories = payments.join(member_history(defaulters, params, rules), "member_id")
    statuses = loans.select(
        "member_id", "loan_id", "funded_amount",
        loan_status_points(params, rules).alias("loan_status_pts"),
        F.col("loan_status").isNull().alias("_no_status"),
    )
    home = home_points_of_loan(F.col("home_pts"), F.col("_no_status"), params, rules)
    healths = (
        join_members(statuses, member_profile(customers, params, rules), hot)
        .withColumns({"home_pts": home, "funded_amt_pts": funded_points(params, rules)})
        .groupBy("member_id", *HEALTH_POINTS).agg(F.count("*").alias("_loans"))
    )
    # Decimal, because the square of a large member's loans can pass the range of a long. One row per member and points on
    # both sides, a few dozen at most, so this join needs no salt.
    n_rows = F.expr("n_payments * cast(_loans as decimal(19,0))").cast(PAIR_COUNT)
    pairs = histories.join(healths, "member_id").withColumn("n_rows", n_rows)
    graded = grade(pairs, params, rules, keep=("member_id", "n_rows"))
    return (
        graded.groupBy("member_id", *SUBSCORES, "loan_total_score", "loan_grade")
        .agg(F.sum("n_rows").cast(PAIR_COUNT).alias("n_rows"))
    )


def grade_distribution(graded: DataFrame) -> DataFrame:
    return graded.groupBy("loan_grade").agg(F.count("*").alias("loans"))


def grade_in_sql(spark: SparkSession, totals: DataFrame, params: ScoreParams = DEFAULTS) -> DataFrame:
    """The letter grade written in SQL, with the cut points as named parameters."""
    return spark.sql(
        """
        select member_id, loan_id, payment_history_pts, loan_default_history_pts, financial_health_pts,
               loan_total_score,
               case when loan_total_score >= :very_good_grade then 'A+'
                    when loan_total_score >= :good_grade then 'B'
                    when loan_total_score >= :bad_grade then 'C'
                    when loan_total_score >= :very_bad_grade then 'D'
                    when loan_total_score >= :unacceptable_grade then 'E'
                    when loan_total_score < :unacceptable_grade then 'F' end as loan_grade
        from {totals}
        """,
        args=params.sql_args(), totals=totals,
    )
