"""Whole runs that appear at once: each writes a folder of its own, and one row in a manifest makes it the current one.

Overwriting a layer in place deletes it before the new one is there: a run that dies half-way leaves readers with neither.
Here a run writes under a new generation. Publishing appends a single row, in a single file, to the manifest of the root; Spark
commits that file as a whole, and the row with the highest number tells what is current. Until then readers see
the old generation, whose files nobody touches. Which old generations may go is the caller's to say; publish() removes none.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

MANIFEST = "number long, generation string"


def _path(root: str) -> str:
    return f"{root.rstrip('/')}/_generations"


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """(number, generation) of all that was published under `root`; empty where nothing was."""
    try:
        return spark.read.schema(MANIFEST).parquet(_path(root))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def new_generation(root: str) -> str:
    """The folder of a run that nobody reads yet."""
    return f"{root.rstrip('/')}/generation-{uuid4().hex}"


def current(spark: SparkSession, root: str) -> str | None:
    """The folder published last; of two runs that took the same number, the one with the larger name."""
    row = manifest(spark, root).orderBy(F.desc("number"), F.desc("generation")).first()
    return None if row is None else row["generation"]


def publish(spark: SparkSession, root: str, generation: str) -> None:
    """Make `generation` the current one. Publishing an older one again goes back to it."""
    last = manifest(spark, root).agg(F.max("number")).first()[0]
    row = [(0 if last is None else last + 1, generation)]
    spark.createDataFrame(row, MANIFEST).coalesce(1).write.mode("append").parquet(_path(root))
