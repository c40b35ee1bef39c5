"""Every operator as a query over the applications of a data set."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from gradewell import schemas
from gradewell.functions.keys import with_member_id, with_unpacked_members
from gradewell.functions.text import year_of
from gradewell.operators import clean, factored, pairs, quality, score, skew, wide
from gradewell.operators.split import LOAN_SOURCES, REPAYMENT_SOURCES
from gradewell.params import LITERAL, ScoreParams
from gradewell.plans import medallion
from gradewell.plans.tables import Tables
from gradewell.sources import files, generations
from gradewell.sources.layout import Layout
from gradewell.sources.scratch import scratch_root

Query = Callable[[SparkSession, str], DataFrame]

BATCH_TIME = "2024-01-31 12:00:00"

CUSTOM = ScoreParams(
    unacceptable=10, very_bad=120, bad=260, good=480, very_good=700, excellent=900,
    unacceptable_grade=700, very_bad_grade=950, bad_grade=1400, good_grade=1900, very_good_grade=2300,
)


def _over(build: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(Tables.of(spark, sf_dir))


# --- scans and sinks ----------------------------------------------------------------------------

# Each of these writes its own copy of the tables when it is called.

#: Text that CSV must bring back as it is.
HOSTILE = ', "quoted", ""twice"" \\ 007 '


def _hostile(df: DataFrame, column: str, line_end: bool = False) -> DataFrame:
    """Commas, quotes, backslashes and blanks in a text column, and empty texts; line ends if asked for."""
    text = F.concat(F.col(column), F.lit(HOSTILE + ("\n" if line_end else "") + "end"))
    return df.withColumn(column, F.when(F.col(column).endswith("3"), F.lit("")).otherwise(text))


def csv_inferred_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide CSV read with inferred numbers, brought to the declared types; text is never inferred."""
    path = f"{scratch_root(spark)}/applications"
    files.write_table(_hostile(Tables.of(spark, sf_dir).applications, "title"), path, "csv")
    text = [f.name for f in schemas.WIDE if isinstance(f.dataType, T.StringType)]
    inferred = files.read_csv(spark, path, text_columns=text, null_mark=files.NULL_MARK)
    return inferred.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schemas.WIDE])


def csv_declared_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans landed under their source names and read back, by position, under the declared ones; the headers are checked."""
    path = f"{scratch_root(spark)}/loans"
    loans = Tables.of(spark, sf_dir).keyed.select(*LOAN_SOURCES.values())
    files.write_table(_hostile(loans, "title", line_end=True), path, "csv", line_ends=True)
    return files.read_csv(spark, path, schemas.LOANS, multi_line=True, null_mark=files.NULL_MARK,
                          source_names=list(LOAN_SOURCES.values()))


def csv_by_header_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans landed in files of two column orders, of which one has a column more, each read by its own header."""
    path = f"{scratch_root(spark)}/loans"
    loans = _hostile(Tables.of(spark, sf_dir).keyed.select(*LOAN_SOURCES.values()), "title")
    odd = F.col("id").cast("long") % 2 == 1
    files.write_table(loans.where(odd), path, "csv")
    other = loans.where(~odd).select(F.lit("x, \"y\"").alias("its, own"), *reversed(loans.columns))
    files.write_table(other, path, "csv", mode="append")
    texts = files.read_csv_by_header(spark, path, list(LOAN_SOURCES.values()), files.NULL_MARK)
    named = texts.select(*[F.col(source).alias(name) for name, source in LOAN_SOURCES.items()])
    return files.typed(named, schemas.LOANS).drop(files.BAD_CELLS)


#: The declared columns of a file with cells and records that do not parse.
DIRTY = T.StructType([schemas.LOANS[c] for c in ("loan_id", "loan_amount", "monthly_installment")])


def _dirty_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans of a CSV file in which amounts are words, records have a cell too many or too few, written once as they were read."""
    root, number = scratch_root(spark), F.col("id").cast("long")
    amount = F.when(number % 10 == 3, F.lit("twelve")).otherwise(F.col("loan_amnt").cast("string"))
    installment = F.when(F.col("term").isNull(), F.lit("n/a")).otherwise(F.col("installment").cast("string"))
    line = F.concat_ws(",", "id", amount, F.when(number % 25 != 8, installment), F.when(number % 25 == 7, F.lit("left over")))
    Tables.of(spark, sf_dir).applications.select(line).write.text(f"{root}/raw")
    rows = files.read_csv_cells(spark, f"{root}/raw", DIRTY, header=False)
    files.write_table(rows, f"{root}/read")
    return spark.read.schema(rows.schema).parquet(f"{root}/read")


def csv_bad_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each cell and record that does not parse, with its text, written to a quarantine."""
    path = f"{scratch_root(spark)}/bad_cells"
    files.write_table(files.bad_cells(_dirty_loans(spark, sf_dir), "loan_id"), path)
    return spark.read.parquet(path)


def csv_good_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of the same file, with the cells that parse."""
    return _dirty_loans(spark, sf_dir).drop(files.BAD_CELLS)


def _written_by_year(spark: SparkSession, sf_dir: str) -> str:
    path = f"{scratch_root(spark)}/loan_scores"
    files.write_table(_graded_by_year(Tables.of(spark, sf_dir), score.DEFAULTS), path, partition_by=["issue_year"])
    return path


def _graded_by_year(t: Tables, params: ScoreParams) -> DataFrame:
    base = payment_base(t).withColumn("issue_year", year_of(F.col("issue_date")))
    points = score.score_points(base, t.customers, t.defaulters, t.hot, params, keep=medallion.SCORE_KEYS)
    return score.grade(points, params, keep=medallion.SCORE_KEYS)


def scores_of_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades of the loans of two years, from a table of which only those years are read."""
    written = spark.read.parquet(_written_by_year(spark, sf_dir))
    return medallion.issued(written, [2010, 2011])


def scores_year_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All grades after those of one year were written anew with other parameters."""
    path = _written_by_year(spark, sf_dir)
    anew = medallion.issued(_graded_by_year(Tables.of(spark, sf_dir), CUSTOM), [2010])
    files.write_table(anew, path, partition_by=["issue_year"], own_partitions_only=True)
    return spark.read.parquet(path)


def _bucketed(spark: SparkSession, tables: dict[str, tuple[DataFrame, str]]) -> list[DataFrame]:
    """Tables written in buckets of their keys and read by name; the names go once the plans know the files."""
    root, read = scratch_root(spark), []
    for entity, (df, key) in tables.items():
        name = f"{entity}_{uuid4().hex}"
        files.write_bucketed(df, name, f"{root}/{entity}", key, 8)
        read.append(spark.table(name))
        read[-1].schema
        spark.sql(f"drop table {name}")
    return read


def payment_base_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repayments with their loans from tables bucketed on the loan: removing copies and the join need no shuffle."""
    t = Tables.of(spark, sf_dir)
    repayments, loans = _bucketed(spark, {"repayments": (t.repayments, "loan_id"), "loans": (t.loans, "loan_id")})
    return score.payment_base(clean.unique_rows(repayments, "loan_id"), clean.unique_rows(loans, "loan_id"))


def member_points_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of members from tables bucketed on the member: both aggregates and their join need no shuffle."""
    t = Tables.of(spark, sf_dir)
    customers, defaulters = _bucketed(spark, {"customers": (t.customers, "member_id"), "defaulters": (t.defaulters, "member_id")})
    return score.member_history(defaulters).join(score.member_profile(customers), "member_id")


def published_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of the generation that was published, beside one that was begun and left."""
    root, customers = scratch_root(spark), Tables.of(spark, sf_dir).landed("customers")
    whole, begun = (Layout(generations.new_generation(root)) for _ in range(2))
    whole.write("bronze", {"customers": customers})
    generations.publish(spark, root, whole.root)
    begun.write("bronze", {"customers": customers.where("grade = 'A'")})
    return medallion.current(spark, root).read(spark, "bronze", "customers")


def csv_permissive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A numeric column with unreadable cells: they become NULL and no row is lost."""
    path = f"{scratch_root(spark)}/installments"
    amount = F.when(F.col("term").isNotNull(), F.col("installment").cast("string")).otherwise(F.lit("n/a, see \"note\""))
    files.write_table(Tables.of(spark, sf_dir).applications.select("id", amount.alias("installment")), path, "csv")
    declared = T.StructType([schemas.LOANS["loan_id"], schemas.LOANS["monthly_installment"]])
    return files.read_csv(spark, path, declared, null_mark=files.NULL_MARK)


def csv_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_root(spark)}/loans"
    loans = _hostile(Tables.of(spark, sf_dir).loans, "loan_title")
    files.write_table(loans, path, "csv")
    return files.read_table(spark, path, "csv", loans.schema)


def medallion_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All layers written under a scratch root; rows per table, counted from what was written."""
    layout = medallion.run(spark, Tables.of(spark, sf_dir).applications, scratch_root(spark), BATCH_TIME)
    return medallion.inventory(spark, layout)


def catalog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean customers written to files, entered in the catalog and read by name."""
    path = f"{scratch_root(spark)}/customers"
    files.write_table(Tables.of(spark, sf_dir).customers, path)
    name = f"customers_{uuid4().hex}"
    files.register_table(spark, name, path)
    read = spark.table(name)
    read.schema  # resolved here, so that the name can go
    spark.sql(f"drop table {name}")
    return read


def medallion_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counted grades that a run of the literal profile writes."""
    layout = medallion.run(spark, Tables.of(spark, sf_dir).applications, scratch_root(spark), BATCH_TIME, rules=LITERAL)
    return layout.read(spark, "gold", "member_scores").drop("ingest_date")


def view_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score totals as a view, graded by SQL that reads the view."""
    points = _points(Tables.of(spark, sf_dir))
    name = f"totals_{uuid4().hex}"
    score.total_score(score.sub_scores(points)).createOrReplaceTempView(name)
    graded = score.grade_in_sql(spark, spark.table(name))
    spark.catalog.dropTempView(name)
    return graded


def preview_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables.of(spark, sf_dir).applications.orderBy("id").limit(10)


# --- projections and cleaning -------------------------------------------------------------------

def add_ingest_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = clean.dedupe(Tables.of(spark, sf_dir).landed("loans_defaulters"))
    stamped = clean.add_ingest_date(landed, BATCH_TIME)
    return stamped.withColumn("ingest_date", F.date_format("ingest_date", "yyyy-MM-dd HH:mm:ss"))


def fill_mean_emp_length(t: Tables) -> DataFrame:
    return t.customers.groupBy("emp_length").agg(F.count("*").alias("n_rows"))


# --- quarantine ---------------------------------------------------------------------------------

def bad_members_union(t: Tables) -> DataFrame:
    return quality.union_of_members(*[quality.duplicate_members(x) for x in (t.customers, t.delinquencies, t.details)])


def exclude_not_in_nulls(t: Tables) -> DataFrame:
    """Repayments whose next date is not in a list: a list with a NULL, one without, and an empty one."""
    dates = t.repayments.select("next_payment_date", "total_principal_received")
    lists = {"with_null": "total_principal_received in (100, 200)", "known": "total_principal_received = 200",
             "empty": "total_principal_received < 0"}
    kept = [
        quality.exclude_listed(t.repayments, dates.where(test).select("next_payment_date"), "next_payment_date", t.slice_rows)
        .select(F.lit(name).alias("list"), "*")
        for name, test in lists.items()
    ]
    return kept[0].unionByName(kept[1]).unionByName(kept[2])


def shared_person_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that different persons share where some applications have their title and employment moved by one column."""
    wide = Tables.of(spark, sf_dir).applications
    moved = (F.col("id").cast("long") % 5 == 0) & F.col("emp_title").isNull()
    return quality.shared_ids(with_member_id(wide.withColumns({
        "emp_title": F.when(moved, F.col("emp_length")).otherwise(F.col("emp_title")),
        "emp_length": F.when(~moved, F.col("emp_length")),
    })))


def _kept_defaulters(t: Tables) -> DataFrame:
    """Exclusion comes before the projections, while rows are still distinct."""
    return quality.exclude(t.defaulters, t.bad, t.hot)


# --- joins --------------------------------------------------------------------------------------

def join_wide(t: Tables) -> DataFrame:
    return wide.join_wide(t.customers, t.unique_loans, t.unique_repayments, t.delinquencies, t.details, t.hot)


def join_wide_clean(t: Tables) -> DataFrame:
    customers = quality.exclude(t.customers, t.bad, t.hot)
    return wide.join_kept(customers, t.unique_loans, t.unique_repayments, _kept_defaulters(t), t.hot)


def join_wide_expanded(t: Tables) -> DataFrame:
    """The join's own columns for all members, made of its factors; clean tables and factors are written once and read."""
    root = scratch_root(t.spark)
    staged = t.staged(root, "customers", "loans", "repayments", "defaulters")
    parts = staged.staged_factored(root)
    return with_unpacked_members(factored.expand(parts, staged.loans, staged.repayments, staged.hot, slice_rows=t.slice_rows))


def payment_base(t: Tables) -> DataFrame:
    return score.payment_base(t.unique_repayments, t.unique_loans)


# --- scoring ------------------------------------------------------------------------------------

def _payments(t: Tables) -> DataFrame:
    return score.score_payments(payment_base(t), t.customers, t.defaulters, t.hot)


def _history(t: Tables) -> DataFrame:
    return score.score_history(payment_base(t), t.customers, t.defaulters, t.hot)


def _points(t: Tables, **options) -> DataFrame:
    return score.score_points(payment_base(t), t.customers, t.defaulters, t.hot, **options)


def _one(stage: Callable[[Tables], DataFrame], *columns: str) -> Query:
    return _over(lambda t: stage(t).select("member_id", "loan_id", *columns))


def loan_grade(t: Tables) -> DataFrame:
    return score.grade(_points(t))


def payment_pairs(t: Tables) -> DataFrame:
    return pairs.payment_pairs(t.repayments, t.loans, rules=LITERAL, slice_rows=t.slice_rows)


def loan_grade_literal(t: Tables) -> DataFrame:
    """The counted grades; clean loans and repayments, which several steps read, are written once."""
    s = t.staged(scratch_root(t.spark), "loans", "repayments", "defaulters")
    return with_unpacked_members(
        score.grade_member_pairs(payment_pairs(s), s.loans, s.customers, s.defaulters, s.hot, rules=LITERAL))


def score_custom_params(t: Tables) -> DataFrame:
    """Other points and cut points; the grade is given in SQL with named parameters."""
    totals = score.total_score(score.sub_scores(_points(t, params=CUSTOM), CUSTOM))
    return score.grade_in_sql(t.spark, totals, CUSTOM)


def score_from_conf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers of score_custom_params set as keys of a session of its own and read from there."""
    session = spark.newSession()
    CUSTOM.to_conf(session)
    params = ScoreParams.from_conf(session)
    return score.grade(_points(Tables.of(session, sf_dir), params=params), params)


def dropped_rows(t: Tables) -> DataFrame:
    counts = [clean.dropped_rows(t.landed(entity), entity) for entity in clean.REQUIRED]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def dropped_rows_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts, taken while the cleaned tables are written."""
    t, root = Tables.of(spark, sf_dir), scratch_root(spark)
    drops = {entity: Observation(f"dropped {entity}") for entity in clean.REQUIRED}
    files.write_tables({f"{root}/{e}": clean.CLEANERS[e](t.landed(e), drops[e]) for e in drops})
    return clean.observed_drops(spark, drops)


# A third of the applications belong to one person; members are cut into slices of so many rows.
SKEWED_SLICE = 100
# Wide applications of one person that one task joins.
WIDE_SLICE = 100_000


def skewed_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applications of which a third carry the person and history of one application, the first of a good payer's kind."""
    wide = Tables.of(spark, sf_dir).applications
    loan = {*LOAN_SOURCES.values(), *REPAYMENT_SOURCES.values()}
    person = [f.name for f in schemas.WIDE if f.name not in loan]
    known = "annual_inc is not null and delinq_2yrs between 1 and 7"
    one = wide.where(known).agg(F.min(F.col("id").cast("long")).cast("string")).scalar()
    of = F.when(F.col("id").cast("long") % 3 == 0, one).otherwise(F.col("id"))
    people = wide.select(F.col("id").alias("_of"), *person)
    own = wide.select(of.alias("_of"), *[f.name for f in schemas.WIDE if f.name in loan])
    # A third of the rows meet one person: they are dealt out in slices.
    hot = skew.hot_buckets(own, "_of", WIDE_SLICE)
    return skew.join_members(own, people, hot, key="_of").select(*schemas.WIDE.fieldNames())


def _one_loan_id(spark: SparkSession, sf_dir: str) -> Tables:
    """Tables of which a third of the loans and repayments carry one placeholder id."""
    wide = Tables.of(spark, sf_dir).applications
    return Tables(wide.withColumn("id", F.when(F.col("id").cast("long") % 3 == 0, F.lit("n/a")).otherwise(F.col("id"))))


def payment_base_one_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repayments with their loans where a placeholder id is on a third of both: it joins with nothing."""
    return payment_base(_one_loan_id(spark, sf_dir))


def repeated_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _one_loan_id(spark, sf_dir)
    return quality.repeated_loans(t.loans, t.repayments)


def _repeated_ids(spark: SparkSession, sf_dir: str) -> Tables:
    """Tables in which an id stands on up to four loans and repayments, and one on a fiftieth of them; ids are salted."""
    number = F.col("id").cast("long")
    repeated = F.when(number % 50 == 0, F.lit("n/a")).otherwise((number - number % 4).cast("string"))
    return Tables(Tables.of(spark, sf_dir).applications.withColumn("id", repeated), slice_rows=SKEWED_SLICE)


def payment_base_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a repayment and a loan of one id, each different one once with how often it occurs."""
    t = _repeated_ids(spark, sf_dir)
    return pairs.expanded(t.repayments, t.loans, t.slice_rows)


def loan_grade_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grades where one good member holds a third of the loans, in slices."""
    return loan_grade(Tables(skewed_applications(spark, sf_dir), slice_rows=SKEWED_SLICE))


QUERIES: dict[str, Query] = {
    "csv_inferred_scan": csv_inferred_scan,
    "csv_declared_scan": csv_declared_scan,
    "csv_by_header_scan": csv_by_header_scan,
    "csv_permissive": csv_permissive,
    "csv_bad_cells": csv_bad_cells,
    "csv_good_cells": csv_good_cells,
    "csv_sink_roundtrip": csv_sink_roundtrip,
    "medallion_layout": medallion_layout,
    "medallion_literal": medallion_literal,
    "scores_of_years": scores_of_years,
    "scores_year_replaced": scores_year_replaced,
    "payment_base_bucketed": payment_base_bucketed,
    "member_points_bucketed": member_points_bucketed,
    "published_generation": published_generation,
    "catalog_scan": catalog_scan,
    "view_scan": view_scan,
    "preview_top10": preview_top10,
    "member_id_hash": _over(lambda t: with_member_id(t.applications).select("id", "member_id")),
    "split_customers": _over(lambda t: t.landed("customers")),
    "split_loans": _over(lambda t: t.landed("loans")),
    "split_repayments": _over(lambda t: t.landed("loans_repayments")),
    "split_defaulters": _over(lambda t: t.landed("loans_defaulters")),
    "add_ingest_date": add_ingest_date,
    "dedupe_rows": _over(lambda t: clean.dedupe(t.landed("customers"))),
    "fill_mean_emp_length": _over(fill_mean_emp_length),
    "clean_customers": _over(lambda t: t.customers),
    "clean_loans": _over(lambda t: t.loans),
    "clean_repayments": _over(lambda t: t.repayments),
    "clean_defaulters": _over(lambda t: t.defaulters),
    "defaulters_delinq": _over(lambda t: t.delinquencies),
    "defaulters_records_enq": _over(lambda t: clean.records_and_enquiries(t.defaulters)),
    "defaulters_detail": _over(lambda t: t.details),
    "dup_members_customers": _over(lambda t: quality.duplicate_members(t.customers)),
    "dup_members_delinq": _over(lambda t: quality.duplicate_members(t.delinquencies)),
    "dup_members_detail": _over(lambda t: quality.duplicate_members(t.details)),
    "dup_members_ranked": _over(lambda t: quality.ranked_duplicates(t.details)),
    "bad_members": _over(lambda t: t.bad),
    "bad_members_union": _over(bad_members_union),
    "exclude_customers": _over(lambda t: quality.exclude(t.customers, t.bad, t.hot)),
    "exclude_delinq": _over(lambda t: clean.delinquencies(_kept_defaulters(t))),
    "exclude_detail": _over(lambda t: clean.detail_records(_kept_defaulters(t))),
    "exclude_not_in": _over(lambda t: quality.exclude(payment_base(t), t.bad, t.hot)),
    "exclude_not_in_nulls": _over(exclude_not_in_nulls),
    "shared_person_ids": shared_person_ids,
    "join_wide": _over(join_wide),
    "join_wide_clean": _over(join_wide_clean),
    "join_wide_expanded": _over(join_wide_expanded),
    "wide_customers_classes": _over(lambda t: t.factored.classes["customers"]),
    "wide_delinq_classes": _over(lambda t: t.factored.classes["delinq"]),
    "wide_detail_classes": _over(lambda t: t.factored.classes["detail"]),
    "wide_membership": _over(lambda t: t.factored.membership),
    "wide_totals": _over(lambda t: factored.member_totals(
        t.customers, t.loans, t.repayments, t.delinquencies, t.details, t.slice_rows)),
    "payment_base": _over(payment_base),
    "score_last_payment": _one(_payments, "last_payment_pts"),
    "score_total_payment": _one(_payments, "total_payment_received_pts"),
    "score_payment_history": _one(_payments, *score.PAYMENT_POINTS, "payment_history_pts"),
    "score_delinq": _one(_history, "delinq_pts"),
    "score_public_record": _one(_history, "public_record_pts"),
    "score_bankruptcies": _one(_history, "public_bankruptcies_pts"),
    "score_enquiries": _one(_history, "enq_pts"),
    "score_default_history": _one(_history, *score.PAYMENT_POINTS, *score.HISTORY_POINTS, "loan_default_history_pts"),
    "score_loan_status": _one(_points, "loan_status_pts"),
    "score_home": _one(_points, "home_pts"),
    "score_funded_amount": _one(_points, "funded_amt_pts"),
    "score_grade_pts": _one(_points, "grade_pts"),
    "score_financial_health": _over(lambda t: score.sub_scores(_points(t)).select(
        "member_id", "loan_id", *score.HEALTH_POINTS, "financial_health_pts")),
    "loan_total_score": _over(lambda t: score.total_score(score.sub_scores(_points(t))).select(
        "member_id", "loan_id", *score.SUBSCORES, "loan_total_score")),
    "loan_grade": _over(loan_grade),
    "loan_grade_from_wide": _over(lambda t: score.grade(score.score_wide(join_wide_clean(t)))),
    "loan_grade_literal": _over(loan_grade_literal),
    "loan_grade_incl_clean": _over(lambda t: score.grade(_points(t, include_clean_members=True))),
    "grade_distribution": _over(lambda t: score.grade_distribution(loan_grade(t))),
    "score_custom_params": _over(score_custom_params),
    "score_from_conf": score_from_conf,
    "dropped_rows": _over(dropped_rows),
    "dropped_rows_observed": dropped_rows_observed,
    "loan_grade_skewed": loan_grade_skewed,
    "payment_base_one_id": payment_base_one_id,
    "repeated_loans": repeated_loans,
    "payment_base_repeated": payment_base_repeated,
    "payment_pairs_repeated": lambda spark, sf_dir: payment_pairs(_repeated_ids(spark, sf_dir)),
    "loan_grade_literal_repeated": lambda spark, sf_dir: loan_grade_literal(_repeated_ids(spark, sf_dir)),
    "join_wide_expanded_repeated": lambda spark, sf_dir: join_wide_expanded(_repeated_ids(spark, sf_dir)),
}
