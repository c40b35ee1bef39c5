"""What several operators need: shared folders, staged tables, words of a text, result columns."""

from __future__ import annotations

import ctypes
import gc
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: Text lower-cased in A-Z only, every other ASCII byte but letters and digits a space.
PLAIN_WORDS = bytes(
    c if c >= 0x80 else ord(chr(c).lower()) if chr(c).isalnum() else 0x20 for c in range(256)
)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share: under spark.checkpoint.dir, else under the warehouse.

    On a cluster a warehouse on the driver's own disk is refused: executors would not see each other's files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local") and re.match(r"file:|/", warehouse):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"{warehouse}/_shared"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def integers(df: DataFrame, column: str) -> Column:
    """The ids of a column as longs; a column of another kind is refused before any work."""
    if not isinstance(df.schema[column].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        raise ValueError(f"{column} must hold integers")
    return F.col(f"`{column.replace('`', '``')}`").cast("long")


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet in the shared folder and read back, which cuts its lineage."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(batches: Iterator) -> Iterator:
    """The batches of a task; after the last one, memory that the Python worker holds but does not use is given back.

    Spark keeps workers for later tasks, and idle ones would count beside the next stage's memory.
    """
    yield from batches
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def with_result(df: DataFrame, result: Column, fields: list[str]) -> DataFrame:
    """`df` with the fields of the struct `result` as columns; columns of those names are replaced.

    `result` is made once, whatever reads its fields.
    """
    own = f"_{uuid.uuid4().hex}"
    kept = [F.col(f"`{c.replace('`', '``')}`") for c in df.columns if c.lower() not in {f.lower() for f in fields}]
    return df.select("*", result.alias(own)).select(*kept, *(F.col(own)[f].alias(f) for f in fields))


def prefixes(values: Column, zero: Column, combine: Callable[[Column, Column], Column], block: int = 256) -> Column:
    """For every element of an array what `combine` makes of `zero` and the elements up to it.

    Folded block by block, so that a list of n results costs n times the block and not the square of n to build. `combine`
    must be associative, with `zero` as its neutral value.
    """
    empty = F.filter(F.array(zero), lambda _: F.lit(False))

    def within(part: Column) -> Column:
        first = F.struct(zero.alias("last"), empty.alias("all"))

        def add(so_far: Column, x: Column) -> Column:
            now = combine(so_far["last"], x)
            return F.struct(now.alias("last"), F.concat(so_far["all"], F.array(now)).alias("all"))

        return F.aggregate(part, first, add)

    blocks = F.ceil(F.size(values) / block).cast("int")
    starts = F.when(blocks > 0, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array().cast("array<int>"))
    parts = F.transform(starts, lambda j: within(F.slice(values, j * block + 1, block)))

    def chain(so_far: Column, part: Column) -> Column:
        shifted = F.transform(part["all"], lambda x: combine(so_far["last"], x))
        return F.struct(
            combine(so_far["last"], part["last"]).alias("last"), F.concat(so_far["all"], F.array(shifted)).alias("all"))

    nothing = F.struct(zero.alias("last"), F.filter(F.array(empty), lambda _: F.lit(False)).alias("all"))
    return F.flatten(F.aggregate(parts, nothing, chain)["all"])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
