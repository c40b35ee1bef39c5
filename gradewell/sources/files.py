"""Read and write tables as files. Options are built per call."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F, types as T

#: How NULL is written in CSV, so that it differs from an empty text.
NULL_MARK = r"\N"


def _csv_options(null_mark: str, multi_line: bool) -> dict[str, object]:
    """Quotes inside a text are doubled, on both sides; a backslash is a character like others."""
    return {"header": True, "escape": '"', "nullValue": null_mark, "emptyValue": "", "multiLine": multi_line}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, corrupt_column: str | None = None,
             multi_line: bool = False, text_columns: Iterable[str] = (), null_mark: str = "",
             source_names: Sequence[str] | None = None) -> DataFrame:
    """CSV with a header. A declared schema names and types the columns by position; without one it is inferred.

    With `source_names`, what the files call the columns, positions decide only where every file's header says so: the job
    that reads a file of other names, or of these in another order, fails. The headers are checked as the files are read,
    which costs nothing; see read_csv_by_header() for files of several orders.

    A cell that does not parse becomes NULL and its row is kept; `corrupt_column` keeps the text of such rows.
    Inference is a pass of its own over all rows; `text_columns` are text whatever they hold. `multi_line` is for raw
    files with line ends inside quotes: each file is then read by one task, so stage it once. Files of
    write_table() are read with its `null_mark`.
    """
    reader = spark.read.options(mode="PERMISSIVE", **_csv_options(null_mark, multi_line))
    if schema is None:
        inferred = reader.options(inferSchema=True).csv(path).schema
        text = set(text_columns)
        schema = T.StructType([T.StructField(f.name, T.StringType() if f.name in text else f.dataType) for f in inferred])
    elif corrupt_column is not None:
        schema = T.StructType([*schema, T.StructField(corrupt_column, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    if source_names is None:
        return reader.option("enforceSchema", True).schema(schema).csv(path)
    if corrupt_column is not None:
        raise ValueError("headers are checked against the declared columns alone; use read_csv_cells() for corrupt records")
    named = T.StructType([T.StructField(n, f.dataType) for n, f in zip(source_names, schema, strict=True)])
    read = reader.option("enforceSchema", False).schema(named).csv(path)
    return read.select(*[F.col(f"`{n}`").alias(f.name) for n, f in zip(source_names, schema)])


def csv_headers(spark: SparkSession, path: str, names: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The files under `path` by their column order, for files whose header holds all of `names`; others raise ValueError.

    The files' first lines are found by tasks, in one pass over the lines as text, without parsing them: a header is the line
    that holds every name. Each order and the list of its files reach the driver, which knows the files anyway. A file with
    two different headers, or one that names a wanted column twice, is refused as well.
    """
    held = F.lit(True)
    for name in names:
        held &= F.col("value").contains(name)
    lines = spark.read.text(path).where(held).select("value", F.col("_metadata.file_path").alias("file"))
    found: dict[str, tuple[str, ...]] = {}
    for line, files in lines.groupBy("value").agg(F.collect_set("file")).collect():
        order = tuple(next(csv.reader([line.lstrip("\ufeff")], doublequote=True)))
        if not set(names) <= set(order):
            continue  # a row that holds the names inside its texts
        if any(order.count(name) > 1 for name in names):
            raise ValueError(f"a header names a column twice: {files[0]}")
        for file in files:
            if found.setdefault(file, order) != order:
                raise ValueError(f"two headers: {file}")
    listed = spark.read.format("binaryFile").load(path).where("length > 0")  # names and sizes; no content is read
    orders: dict[tuple[str, ...], list[str]] = {}
    for file, name in listed.select("_metadata.file_path", "path").collect():
        if file not in found:
            raise ValueError(f"no header with the wanted columns: {file}")
        orders.setdefault(found[file], []).append(name)
    return orders


def read_csv_by_header(spark: SparkSession, path: str, names: Sequence[str], null_mark: str = "",
                       multi_line: bool = False, record_column: str | None = None) -> DataFrame:
    """The columns `names` of CSV files as texts, found in each file by its own header.

    Files may have the columns in any order and others beside them; each order is one scan, which parses the wanted columns
    only. `record_column` keeps the text of records with too many or too few cells. A file without one of the names is refused.
    """
    scans = None
    for order, paths in sorted(csv_headers(spark, path, names).items()):
        own = [n if n in names else f"_{i}" for i, n in enumerate(order)]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in own])
        reader = spark.read.options(mode="PERMISSIVE", **_csv_options(null_mark, multi_line))
        wanted = [F.col(f"`{n}`") for n in names]
        if record_column is not None:
            # Records are measured against all columns, so none is pruned here.
            schema = schema.add(record_column, T.StringType())
            reader = reader.option("columnNameOfCorruptRecord", record_column)
            wanted.append(F.col(record_column))
        scan = reader.schema(schema).csv(paths).select(*wanted)
        scans = scan if scans is None else scans.unionByName(scan)
    if scans is None:
        more = [] if record_column is None else [record_column]
        return spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in [*names, *more]]))
    return scans


def read_csv_cells(spark: SparkSession, path: str, schema: T.StructType, null_mark: str = "", multi_line: bool = False,
                   header: bool = True, record_column: str = "_record") -> DataFrame:
    """CSV by position with declared types, and in BAD_CELLS what could not be read of each row; see typed().

    Every cell is read as text and cast, so one that does not parse costs neither its row nor its neighbours, and its text and
    column are kept. Write the result once and cut the good columns and bad_cells() from the copy.
    """
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema]).add(record_column, T.StringType())
    options = _csv_options(null_mark, multi_line) | {"header": header, "columnNameOfCorruptRecord": record_column}
    return typed(spark.read.options(mode="PERMISSIVE", **options).schema(texts).csv(path), schema, record_column)


#: Cells that did not parse, beside the columns of their row: an array of (column_name, cell).
BAD_CELLS = "_bad_cells"
BAD_CELL_TYPE = "array<struct<column_name:string,cell:string>>"


def typed(texts: DataFrame, schema: T.StructType, record_column: str | None = None) -> DataFrame:
    """Text columns brought to the types of `schema`, and BAD_CELLS: for every cell that does not parse its column and text.

    Such a cell is NULL in its column and the other cells of its row stay. An empty cell is NULL and not listed. `record_column` holds the text of records that had
    too many or too few cells; it is listed under its own name and dropped.
    """
    told = []
    for field in schema:
        if not isinstance(field.dataType, T.StringType):
            cell = F.col(f"`{field.name}`")
            broken = cell.isNotNull() & cell.try_cast(field.dataType).isNull()
            told.append(F.when(broken, F.struct(F.lit(field.name).alias("column_name"), cell.alias("cell"))))
    if record_column is not None:
        record = F.col(record_column)
        told.append(F.when(record.isNotNull(), F.struct(F.lit(record_column).alias("column_name"), record.alias("cell"))))
    bad = F.filter(F.array(*told), lambda x: x.isNotNull()) if told else F.array()
    return texts.select(
        *[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema], bad.cast(BAD_CELL_TYPE).alias(BAD_CELLS))


def bad_cells(rows: DataFrame, *keys: str) -> DataFrame:
    """Every listed cell once: the keys of its row, column_name and cell."""
    listed = rows.where(F.size(BAD_CELLS) > 0).select(*keys, F.explode(BAD_CELLS).alias("bad"))
    return listed.select(*keys, "bad.column_name", "bad.cell")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | None = None) -> DataFrame:
    if fmt == "csv":
        return read_csv(spark, path, schema, null_mark=NULL_MARK)
    reader = spark.read.format(fmt)
    return (reader if schema is None else reader.schema(schema)).load(path)


def _csv_safe(df: DataFrame, line_ends: bool) -> DataFrame:
    """`df` whose texts come back as they are; a text that would not fails the job that writes it."""
    columns = []
    for field in df.schema:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            broken = value == NULL_MARK if line_ends else (value == NULL_MARK) | value.rlike(r"[\r\n]")
            told = F.raise_error(F.lit(f"CSV cannot hold this text of {field.name}: a line end, or the mark of NULL"))
            value = F.when(broken, told.cast("string")).otherwise(value).alias(field.name)
        columns.append(value)
    return df.select(*columns)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", line_ends: bool = False,
                partition_by: Sequence[str] = (), own_partitions_only: bool = False) -> None:
    """CSV refuses texts with line ends unless `line_ends` is set; such files are then read with `multi_line`.

    Overwriting replaces the table, or with `own_partitions_only` the partitions that `df` has rows of; the others stay.
    """
    writer = _writer(df, fmt, mode, line_ends)
    if partition_by:
        replaced = "dynamic" if own_partitions_only else "static"
        writer = writer.option("partitionOverwriteMode", replaced).partitionBy(*partition_by)
    writer.save(path)


def _writer(df: DataFrame, fmt: str, mode: str, line_ends: bool) -> DataFrameWriter:
    if fmt == "csv":
        # Keep blanks around values: by default the writer trims them. An empty text is written in quotes.
        blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        options = _csv_options(NULL_MARK, False) | {"emptyValue": '""'} | blanks
        options.pop("multiLine")
        return _csv_safe(df, line_ends).write.format(fmt).mode(mode).options(**options)
    writer = df.write.format(fmt).mode(mode)
    # Person ids are hex digits, which zstd halves and snappy cannot shorten.
    return writer.option("compression", "zstd") if fmt == "parquet" else writer


def write_tables(tables: dict[str, DataFrame], fmt: str = "parquet", partition_by: dict[str, Sequence[str]] | None = None,
                 own_partitions_only: bool = False) -> None:
    """Write independent tables, path by path, as concurrent Spark jobs; the first failure is raised."""
    by = partition_by or {}
    with ThreadPoolExecutor(max_workers=len(tables)) as pool:
        jobs = [
            pool.submit(inheritable_thread_target(df.sparkSession)(write_table), df, path, fmt,
                        partition_by=by.get(path, ()), own_partitions_only=own_partitions_only)
            for path, df in tables.items()
        ]
        for job in jobs:
            job.result()


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """Files at `path` bucketed and sorted by `key`, and the catalog table `name` that knows it.

    Tables with as many buckets on one key are joined, and grouped on it, without a shuffle. A file per bucket: the rows are
    dealt by the key before they are written. Buckets are right where a bucket of the largest table fits a task; a key that holds
    a third of the rows belongs to skew.join_members() and not here.
    """
    dealt = df.repartition(buckets, F.col(key))
    dealt.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").option("path", path).saveAsTable(name)


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
                   schema: T.StructType | None = None) -> None:
    """Enter written files in the catalog under a name; the files stay where they are.

    A table of that name is replaced only if it is an external one at the same place.
    """
    if spark.catalog.tableExists(name):
        told = {r["col_name"]: r["data_type"] for r in spark.sql(f"describe table extended {name}").collect()}
        place = re.sub(r"^file:/+", "/", told.get("Location", ""))
        if told.get("Type") != "EXTERNAL" or place.rstrip("/") != re.sub(r"^file:/+", "/", path).rstrip("/"):
            raise ValueError(f"{name} exists and is not an external table at {path}")
        spark.sql(f"drop table {name}")
    options = {"mode": "PERMISSIVE"} | _csv_options(NULL_MARK, False) if fmt == "csv" else {}
    spark.catalog.createTable(name, path=path, source=fmt, schema=schema, **{k: str(v) for k, v in options.items()})
