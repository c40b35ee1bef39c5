"""Where each table of a layer lives under a root, in which format and with which columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from gradewell import schemas
from gradewell.sources import files

# Tables of each layer.
LAYERS = {
    "bronze": {
        "customers": schemas.CUSTOMERS,
        "loans": schemas.LOANS,
        "loans_repayments": schemas.REPAYMENTS,
        "loans_defaulters": schemas.DEFAULTERS,
    },
    "silver": {
        "customers": schemas.CLEAN_CUSTOMERS,
        "loans": schemas.CLEAN_LOANS,
        "loans_repayments": schemas.CLEAN_REPAYMENTS,
        "loans_defaulters": schemas.CLEAN_DEFAULTERS,
        "loans_defaulters_delinq": schemas.DELINQUENCIES,
        "loans_defaulters_records_enq": schemas.CLEAN_DEFAULTERS,
        "loans_defaulters_detail_records_enq": schemas.DETAILS,
        "total_files_counted": schemas.COUNTED_FILES,
        "wide_totals": schemas.WIDE_TOTALS,
        "wide_membership": schemas.WIDE_MEMBERSHIP,
        "wide_customers_classes": schemas.CUSTOMER_CLASSES,
        "wide_delinq_classes": schemas.DELINQ_CLASSES,
        "wide_detail_classes": schemas.DETAIL_CLASSES,
    },
    "quarantine": {
        "bad_data": schemas.BAD_MEMBERS,
        "repeated_loans": schemas.REPEATED_LOANS,
        "dropped_rows": schemas.DROPPED_ROWS,
        "shared_ids": schemas.SHARED_IDS,
        "bad_cells": schemas.BAD_CELLS,
    },
    "gold": {
        "customers": schemas.CLEAN_CUSTOMERS,
        "loans_defaulters": schemas.CLEAN_DEFAULTERS,
        "loans_defaulters_delinq": schemas.DELINQUENCIES,
        "loans_defaulters_detail_records_enq": schemas.DETAILS,
        "total_files": schemas.TOTAL_FILES,
        "loan_scores": schemas.LOAN_SCORES,
    },
}
# Tables laid out by the year of issue, so that a year is read and replaced alone. The column comes last.
PARTITIONS = {("gold", "total_files"): ("issue_year",), ("gold", "loan_scores"): ("issue_year",)}
# Written only by the profile that joins loans on the member.
OPTIONAL = {("gold", "member_scores"): schemas.MEMBER_SCORES}


@dataclass(frozen=True)
class Layout:
    """Tables are Parquet by default. CSV works for every layer whose texts hold no line end; others fail to be written."""

    root: str
    bronze_format: str = "parquet"
    table_format: str = "parquet"

    def schema(self, layer: str, entity: str):
        schema = LAYERS[layer].get(entity) or OPTIONAL.get((layer, entity))
        if schema is None:
            raise KeyError(f"{layer} has no table {entity}")
        return schema

    def format(self, layer: str) -> str:
        return self.bronze_format if layer == "bronze" else self.table_format

    def path(self, layer: str, entity: str) -> str:
        self.schema(layer, entity)
        return f"{self.root}/{layer}/{entity}"

    def read(self, spark: SparkSession, layer: str, entity: str) -> DataFrame:
        """The columns are declared, so no job has to look for them."""
        return files.read_table(spark, self.path(layer, entity), self.format(layer), self.schema(layer, entity))

    def write(self, layer: str, tables: dict[str, DataFrame], own_partitions_only: bool = False) -> None:
        """Write tables of a layer that do not depend on each other; whole, or the partitions that they have rows of."""
        files.write_tables({
            self.path(layer, entity): df.select(*self.schema(layer, entity).fieldNames())
            for entity, df in tables.items()
        }, self.format(layer), {self.path(layer, e): PARTITIONS[layer, e] for e in tables if (layer, e) in PARTITIONS},
            own_partitions_only)

    @property
    def staged_applications(self) -> str:
        """The keyed wide table, in Parquet, that the bronze tables are cut from."""
        return f"{self.root}/bronze/applications"

    @property
    def hot_buckets(self) -> str:
        """Which members the joins of later steps salt, in Parquet."""
        return f"{self.root}/silver/hot_buckets"

    def tables(self) -> list[tuple[str, str]]:
        return [(layer, entity) for layer, entities in LAYERS.items() for entity in entities]
