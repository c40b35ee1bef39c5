"""The tables of one data set, each a lazy plan over its source files."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from gradewell.functions.keys import with_member_id, with_packed_members
from gradewell.operators import clean, factored, quality, skew, split
from gradewell.sources import files
from gradewell.sources.applications import applications


class Tables:
    """Wide, landed, cleaned and filtered tables of a set of applications."""

    def __init__(self, wide: DataFrame, slice_rows: int = skew.SLICE_ROWS):
        self.spark = wide.sparkSession
        self.slice_rows = slice_rows
        self.applications = wide
        self.keyed = with_member_id(wide)

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Tables:
        return cls(applications(spark, sf_dir))

    def staged(self, root: str, *entities: str) -> Tables:
        """The same tables with person ids packed; those of `entities` are written under `root` once and read from there.

        For queries that read a clean table many times: otherwise each reading cleans the source anew.
        """
        t = Tables(self.applications, self.slice_rows)
        clean_tables = {e: with_packed_members(getattr(self, e)) for e in ("customers", "loans", "repayments", "defaulters")}
        files.write_tables({f"{root}/{e}": clean_tables[e] for e in entities})
        for entity, table in clean_tables.items():
            setattr(t, entity, self._read(f"{root}/{entity}", table) if entity in entities else table)
        hot = skew.hot_buckets(
            t.loans.select("member_id").unionAll(t.defaulters.select("member_id")), "member_id", self.slice_rows)
        files.write_table(hot, f"{root}/hot")
        t.hot = self._read(f"{root}/hot", hot)
        return t

    def staged_factored(self, root: str) -> factored.Factored:
        """The factors of the five-table join, each written under `root` once."""
        totals = factored.member_totals(
            self.customers, self.loans, self.repayments, self.delinquencies, self.details, self.slice_rows)
        files.write_table(totals, f"{root}/totals")
        totals = self._read(f"{root}/totals", totals)
        parts = factored.factor(self.customers, self.delinquencies, self.details, totals, self.hot)
        written = {"membership": parts.membership, **parts.classes}
        files.write_tables({f"{root}/wide_{name}": df for name, df in written.items()},
                           partition_by={f"{root}/wide_membership": ("kind",)})
        read = {name: self._read(f"{root}/wide_{name}", df) for name, df in written.items()}
        return factored.Factored({kind: read[kind] for kind in factored.KINDS}, read["membership"])

    def _read(self, path: str, written: DataFrame) -> DataFrame:
        return self.spark.read.schema(written.schema).parquet(path).select(*written.columns)

    def landed(self, entity: str) -> DataFrame:
        return split.SPLITS[entity](self.keyed)

    def cleaned(self, entity: str) -> DataFrame:
        return clean.CLEANERS[entity](self.landed(entity))

    @cached_property
    def customers(self) -> DataFrame:
        return self.cleaned("customers")

    @cached_property
    def loans(self) -> DataFrame:
        return self.cleaned("loans")

    @cached_property
    def repayments(self) -> DataFrame:
        return self.cleaned("loans_repayments")

    @cached_property
    def unique_loans(self) -> DataFrame:
        return clean.unique_loans(self.landed("loans"))

    @cached_property
    def unique_repayments(self) -> DataFrame:
        return clean.unique_repayments(self.landed("loans_repayments"))

    @cached_property
    def defaulters(self) -> DataFrame:
        return self.cleaned("loans_defaulters")

    @cached_property
    def delinquencies(self) -> DataFrame:
        return clean.delinquencies(self.defaulters)

    @cached_property
    def details(self) -> DataFrame:
        return clean.detail_records(self.defaulters)

    @cached_property
    def bad(self) -> DataFrame:
        return quality.bad_members(self.customers, self.defaulters)

    @cached_property
    def hot(self) -> DataFrame:
        return skew.hot_buckets(self.keyed, "member_id", self.slice_rows)

    @cached_property
    def factored(self) -> factored.Factored:
        totals = factored.member_totals(
            self.customers, self.loans, self.repayments, self.delinquencies, self.details, self.slice_rows)
        return factored.factor(self.customers, self.delinquencies, self.details, totals, self.hot)
