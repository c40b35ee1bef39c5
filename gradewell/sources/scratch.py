"""Scratch folders for queries that write and read back."""

from __future__ import annotations

import re
from uuid import uuid4

from pyspark.sql import SparkSession


def scratch_root(spark: SparkSession) -> str:
    """A new folder that driver and executors share: under spark.checkpoint.dir, else under the warehouse.

    On a cluster a warehouse on the driver's own disk is refused: executors would not see each other's files.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local") and re.match(r"file:|/", warehouse):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = f"{warehouse}/_scratch"
    return f"{shared.rstrip('/')}/gradewell-{uuid4().hex}"
