"""The whole run: raw applications to bronze, silver, quarantine and gold.

Each layer is written before the next one starts and is read back from its files, so a lost executor costs
at most the stage it was working on and no step recomputes an earlier layer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from gradewell.functions.keys import with_member_id, with_packed_members, with_unpacked_members
from gradewell.functions.text import year_of
from gradewell.operators import clean, factored, pairs, quality, score, skew, split, wide
from gradewell.params import REPAIRED, RuleSet, ScoreParams
from gradewell.sources import files, generations
from gradewell.sources.layout import Layout


def land_bronze(spark: SparkSession, applications: DataFrame, layout: Layout) -> None:
    """Key the wide input, stage it once in Parquet, and cut the four entity tables from the staged copy.

    The raw input, often CSV, is scanned once; each table then reads only its own columns.
    """
    files.write_table(with_member_id(applications), layout.staged_applications)
    keyed = spark.read.parquet(layout.staged_applications)
    layout.write("bronze", {entity: cut(keyed) for entity, cut in split.SPLITS.items()})


DERIVED = {
    "loans_defaulters_delinq": clean.delinquencies,
    "loans_defaulters_records_enq": clean.records_and_enquiries,
    "loans_defaulters_detail_records_enq": clean.detail_records,
}


def build_silver(spark: SparkSession, layout: Layout, batch_time: str) -> None:
    """Write the cleaned tables and what they are derived from; the rows they drop are counted as they are written."""
    drops = {entity: Observation(f"dropped {entity}") for entity in clean.REQUIRED}
    cleaned = {}
    for entity, cleaner in clean.CLEANERS.items():
        landed = _read(spark, layout, "bronze", entity)
        rows = cleaner(landed, drops[entity]) if entity in drops else cleaner(landed)
        cleaned[entity] = clean.add_ingest_date(rows, batch_time)
    _write(layout, "silver", cleaned)
    _write(layout, "quarantine", {"dropped_rows": clean.observed_drops(spark, drops)})
    defaulters = _read(spark, layout, "silver", "loans_defaulters")
    _write(layout, "silver", {entity: derive(defaulters) for entity, derive in DERIVED.items()})


def mark_hot_members(spark: SparkSession, layout: Layout) -> None:
    """Find the members to salt, once, by their loans and default records: one narrow column of each."""
    ids = [_read(spark, layout, "silver", entity).select("member_id") for entity in ("loans", "loans_defaulters")]
    files.write_table(skew.hot_buckets(ids[0].unionByName(ids[1]), "member_id"), layout.hot_buckets)


def quarantine(spark: SparkSession, layout: Layout) -> None:
    """Write the bad member ids and the repeated loan ids, then the tables without the members."""
    customers, defaulters = (_read(spark, layout, "silver", e) for e in ("customers", "loans_defaulters"))
    loans, repayments = (layout.read(spark, "silver", e) for e in ("loans", "loans_repayments"))
    _write(layout, "quarantine", {
        "bad_data": quality.bad_members(customers, defaulters),
        "repeated_loans": quality.repeated_loans(loans, repayments),
    })
    bad, hot = _read(spark, layout, "quarantine", "bad_data"), _hot(spark, layout)
    _write(layout, "gold", {
        "customers": quality.exclude(customers, bad, hot),
        "loans_defaulters": quality.exclude(defaulters, bad, hot),
    })
    kept = _read(spark, layout, "gold", "loans_defaulters")
    _write(layout, "gold", {
        "loans_defaulters_delinq": clean.delinquencies(kept),
        "loans_defaulters_detail_records_enq": clean.detail_records(kept),
    })


def build_wide(spark: SparkSession, layout: Layout) -> None:
    """The wide gold table, one row per loan of the members that are not quarantined, made of the counted one."""
    customers = _read(spark, layout, "gold", "customers").drop("ingest_date")
    counted = _read(spark, layout, "silver", "total_files_counted")
    defaulters = _read(spark, layout, "gold", "loans_defaulters")
    kept = wide.kept_of_counted(counted, customers, defaulters, _hot(spark, layout))
    _write(layout, "gold", {"total_files": kept.withColumn("issue_year", year_of(F.col("issue_date")))})


def build_counted_wide(spark: SparkSession, layout: Layout) -> None:
    """The wide table of all members, quarantined ones too, in factored form: one row per loan."""
    customers = _read(spark, layout, "silver", "customers").select("member_id")
    loans, repayments = _loans_and_repayments(spark, layout)
    delinquencies = _read(spark, layout, "silver", "loans_defaulters_delinq").select("member_id")
    details = _read(spark, layout, "silver", "loans_defaulters_detail_records_enq").select("member_id")
    _write(layout, "silver", {
        "total_files_counted": wide.join_wide_by_loan(customers, loans, repayments, delinquencies, details, _hot(spark, layout)),
    })


def build_factored_wide(spark: SparkSession, layout: Layout) -> None:
    """The five-table join of all members as classes of equal rows and who holds them; expand_wide() makes its rows."""
    customers, loans, repayments, delinquencies, details = (_read(spark, layout, "silver", e) for e in WIDE_SIDES)
    _write(layout, "silver", {"wide_totals": factored.member_totals(customers, loans, repayments, delinquencies, details)})
    totals = _read(spark, layout, "silver", "wide_totals")
    parts = factored.factor(customers.drop("ingest_date"), delinquencies, details, totals, _hot(spark, layout))
    _write(layout, "silver", {
        "wide_membership": parts.membership,
        **{f"wide_{kind}_classes": parts.classes[kind] for kind in factored.KINDS},
    })


WIDE_SIDES = ["customers", "loans", "loans_repayments", "loans_defaulters_delinq", "loans_defaulters_detail_records_enq"]


def expand_wide(spark: SparkSession, layout: Layout, members: DataFrame | None = None) -> DataFrame:
    """The rows of the five-table join, all columns, with how often each occurs: of `members`, or of all."""
    parts = factored.Factored(
        {kind: _read(spark, layout, "silver", f"wide_{kind}_classes") for kind in factored.KINDS},
        _read(spark, layout, "silver", "wide_membership"))
    loans, repayments = _read(spark, layout, "silver", "loans"), _read(spark, layout, "silver", "loans_repayments")
    asked = None if members is None else with_packed_members(members)
    return with_unpacked_members(factored.expand(parts, loans, repayments.drop("ingest_date"), _hot(spark, layout), asked))


def list_faults(spark: SparkSession, layout: Layout) -> None:
    """What the landed applications got wrong: cells that did not parse, and ids that different persons share."""
    keyed = spark.read.parquet(layout.staged_applications)
    if files.BAD_CELLS in keyed.columns:
        cells = files.bad_cells(keyed, "id")
    else:
        cells = spark.createDataFrame([], layout.schema("quarantine", "bad_cells"))
    _write(layout, "quarantine", {"bad_cells": cells, "shared_ids": quality.shared_ids(with_packed_members(keyed))})


SCORE_KEYS = (*score.KEYS, "issue_year")


def score_loans(spark: SparkSession, layout: Layout, batch_time: str, params: ScoreParams = score.DEFAULTS,
                rules: RuleSet = REPAIRED, include_clean_members: bool = False, years: Sequence[int] | None = None) -> None:
    """Grades from the wide gold table, whose rows are the loans to score: no join is left to do.

    `years` scores the loans issued then, reading and replacing nothing but those partitions. Members without a delinquency are not in the wide table; including them takes the join again. Rules that join loans
    a second time on the member also give the grades of those pairs, counted, as `member_scores`.
    """
    if include_clean_members:
        loans, repayments = _loans_and_repayments(spark, layout)
        base = score.payment_base(repayments, loans).withColumn("issue_year", year_of(F.col("issue_date")))
        points = score.score_points(
            base if years is None else base.where(F.col("issue_year").isin(*years)), _read(spark, layout, "gold", "customers"),
            _read(spark, layout, "gold", "loans_defaulters"), _hot(spark, layout), params, rules, include_clean_members, SCORE_KEYS)
    else:
        points = score.score_wide(issued(layout.read(spark, "gold", "total_files"), years), params, rules, SCORE_KEYS)
    graded = clean.add_ingest_date(score.grade(points, params, rules, SCORE_KEYS), batch_time)
    _write(layout, "gold", {"loan_scores": graded}, own_partitions_only=years is not None)
    if years is not None:
        return
    if rules.loans_by_member:
        silver = {e: _read(spark, layout, "silver", e) for e in clean.CLEANERS}
        if rules.keep_repeated_loans:
            payments = pairs.payment_pairs(silver["loans_repayments"], silver["loans"], params, rules)
        else:
            loans, repayments = _loans_and_repayments(spark, layout)
            payments = score.counted_payments(score.payment_base(repayments, loans), params, rules)
        graded = score.grade_member_pairs(
            payments, silver["loans"], silver["customers"], silver["loans_defaulters"], _hot(spark, layout), params, rules)
        _write(layout, "gold", {"member_scores": clean.add_ingest_date(graded, batch_time)})


def run(spark: SparkSession, applications: DataFrame, layout: Layout | str, batch_time: str,
        params: ScoreParams = score.DEFAULTS, rules: RuleSet = REPAIRED,
        include_clean_members: bool = False) -> Layout:
    """All layers, under a root or in a given layout, from a wide table in the declared schema."""
    layout = Layout(layout) if isinstance(layout, str) else layout
    land_bronze(spark, applications, layout)
    build_silver(spark, layout, batch_time)
    mark_hot_members(spark, layout)
    build_counted_wide(spark, layout)
    build_factored_wide(spark, layout)
    list_faults(spark, layout)
    quarantine(spark, layout)
    build_wide(spark, layout)
    score_loans(spark, layout, batch_time, params, rules, include_clean_members)
    return layout


def issued(table: DataFrame, years: Sequence[int] | None) -> DataFrame:
    """Rows of a gold table of loans issued in `years`, or all; other years' partitions are not read."""
    return table if years is None else table.where(F.col("issue_year").isin(*years))


def run_published(spark: SparkSession, applications: DataFrame, root: str, batch_time: str, **options) -> Layout:
    """A run under a generation of its own, published when all its layers are written.

    A run that dies leaves the generation before it as it was, and current() gives that.
    """
    layout = run(spark, applications, Layout(generations.new_generation(root)), batch_time, **options)
    generations.publish(spark, root, layout.root)
    return layout


def current(spark: SparkSession, root: str) -> Layout | None:
    """The layers published last under `root`."""
    path = generations.current(spark, root)
    return None if path is None else Layout(path)


def bucket_silver(spark: SparkSession, layout: Layout, database: str, buckets: int) -> dict[str, str]:
    """Copies of the silver tables as catalog tables, bucketed on the key that scoring joins them by; their names.

    Loans and repayments meet on the loan, customers and default histories on the member, without a shuffle.
    """
    spark.sql(f"create database if not exists `{database}`")
    names = {}
    for entity, key in BUCKET_KEYS.items():
        names[entity] = f"{database}.silver_{entity}_by_{key}"
        files.write_bucketed(layout.read(spark, "silver", entity), names[entity], f"{layout.root}/bucketed/{entity}", key, buckets)
    return names


BUCKET_KEYS = {"customers": "member_id", "loans": "loan_id", "loans_repayments": "loan_id", "loans_defaulters": "member_id"}


def inventory(spark: SparkSession, layout: Layout) -> DataFrame:
    """Rows of every table written."""
    counts = None
    for layer, entity in layout.tables():
        count = layout.read(spark, layer, entity).agg(F.count("*").alias("n_rows"))
        row = count.select(F.lit(layer).alias("layer"), F.lit(entity).alias("entity"), "n_rows")
        counts = row if counts is None else counts.unionByName(row)
    return counts


def register_views(spark: SparkSession, layout: Layout, prefix: str = "") -> list[str]:
    """Temp views `<prefix><layer>_<entity>` over the written tables, for SQL."""
    names = []
    for layer, entity in layout.tables():
        name = f"{prefix}{layer}_{entity}"
        layout.read(spark, layer, entity).createOrReplaceTempView(name)
        names.append(name)
    return names


def register_tables(spark: SparkSession, layout: Layout, database: str) -> list[str]:
    """Catalog tables `<database>.<layer>_<entity>` over the written files, which stay where they are."""
    spark.sql(f"create database if not exists `{database}`")
    names = []
    for layer, entity in layout.tables():
        name = f"{database}.{layer}_{entity}"
        files.register_table(spark, name, layout.path(layer, entity), layout.format(layer), layout.schema(layer, entity))
        names.append(name)
    return names


def _read(spark: SparkSession, layout: Layout, layer: str, entity: str) -> DataFrame:
    """A table whose person ids are packed: they are half of what most steps shuffle."""
    return with_packed_members(layout.read(spark, layer, entity))


def _write(layout: Layout, layer: str, tables: dict[str, DataFrame], **options) -> None:
    """Tables with packed person ids, written with the texts."""
    layout.write(layer, {entity: _as_text(df) for entity, df in tables.items()}, **options)


def _as_text(table: DataFrame) -> DataFrame:
    is_packed = "member_id" in table.columns and isinstance(table.schema["member_id"].dataType, T.BinaryType)
    return with_unpacked_members(table) if is_packed else table


def _hot(spark: SparkSession, layout: Layout) -> DataFrame:
    return spark.read.schema("_bucket int, _salts int").parquet(layout.hot_buckets)


def _loans_and_repayments(spark: SparkSession, layout: Layout) -> tuple[DataFrame, DataFrame]:
    """Both without the ids that stand on several rows, ready to be joined."""
    loans = _read(spark, layout, "silver", "loans")
    repayments = _read(spark, layout, "silver", "loans_repayments").drop("ingest_date")
    return clean.unique_rows(loans, "loan_id"), clean.unique_rows(repayments, "loan_id")
