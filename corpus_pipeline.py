"""From raw documents to training sequences: toxicity, near duplicates, benchmarks, secrets, packing.

Each stage reads all that the one before it kept and gives back the columns of documents; the last gives the pieces of
the packed sequences. Between stages the documents are a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gradewell.llm import decontamination, near_dup, packing, secret_scan, toxicity
from gradewell.llm.common import staged, table


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not judged toxic."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs.select(F.struct("*").alias("row"), F.col("text")), model)
    return scored.where("predicted = 0").select("row.*")


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of near copies; rows without an id stay.

    Rows are compared, not ids: of texts that share an id each stays that is no near copy of one that stays. Of a group's rows
    with the smallest id the one with the smallest hash of the text stays, of equal texts that of the whole row.
    """
    hashed = [c for c, kind in docs.dtypes if "map<" not in kind]
    order = F.struct(F.col("doc_id"), F.xxhash64("text").alias("text"), F.xxhash64(*hashed).alias("whole"))
    number = F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())
    # Numbers are read back from a written table only, where they are fixed.
    rows = staged(docs.select(number.alias("number"), F.struct("*").alias("row"), order.alias("order")), "numbered")
    found = near_dup.near_duplicates(rows.select("number", "row.text"), id_col="number").select("number", "component_id")
    ordered = found.where("number IS NOT NULL").join(rows.select("number", "order"), "number")
    first = ordered.groupBy("component_id").agg(F.min_by("number", F.struct("order", "number")).alias("number"))
    kept = rows.join(staged(first.select("number"), "kept"), "number", "left_semi")
    return kept.unionByName(rows.where("number IS NULL")).select("row.*")


def _decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def _secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in the texts replaced by a mark and the texts measured anew."""
    clean = secret_scan.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def _packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the sequences, with their token ids."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", _toxicity),
    ("near_duplicates", _near_duplicates),
    ("decontamination", _decontamination),
    ("secrets", _secrets),
    ("packing", _packing),
]

#: Compression, signatures and tokenizers are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences of all documents of `sf_dir` that the stages keep.

    Null and empty texts pass every stage and are packed as their last token alone; rows without an id are judged by their
    texts, never grouped, and packed. An empty table gives no piece. Columns beside those of documents ride along up to the packing.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
