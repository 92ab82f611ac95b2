"""Fact scans: one landed month, one partition of a table, or a whole table."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import MONTH_KEYS, RunKey
from tidemark.sources.files import Store
from tidemark.sources.versions import (
    MARKS,
    VERSION,
    current_months,
    month_path,
    written_schema,
)

# Carries the file name until the audit columns are added; landed data may have any other name.
SOURCE_FILE = "_source_file"
_ABSENT = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def _read(open_path: Callable[[str], DataFrame], path: str, what: str) -> DataFrame:
    """Open a path; absent or empty input becomes a ``FileNotFoundError`` that says what it was."""
    try:
        return open_path(path)
    except AnalysisException as error:
        if error.getCondition() in _ABSENT:
            raise FileNotFoundError(f"no input for {what}: {path}") from error
        raise


def read_month_file(spark: SparkSession, path: str, key: RunKey) -> DataFrame:
    """One landed month, a file or a directory of part files.

    Parts may differ in their columns: the month has all of them, NULL in rows of a part that lacks
    one. The null rule takes such rows out like any others.
    """
    return _read(spark.read.option("mergeSchema", True).parquet, path, f"month {key}")


def with_source(scan: DataFrame) -> DataFrame:
    """A scan with ``SOURCE_FILE``, the name of the file each row came from.

    The name comes from the scan itself; asked for above a shuffle it would be empty. Only take it
    where it is used: Spark does not prune the file metadata of a scan whose name is dropped again.
    """
    return scan.select("*", F.col("_metadata.file_name").alias(SOURCE_FILE))


def read_partition(spark: SparkSession, root: str, key: RunKey) -> DataFrame:
    """The current version of one (year, month) of a table, without the partition columns.

    Reading the exact leaf lists one directory instead of discovering every month.
    """
    return _read(spark.read.parquet, month_path(spark, root, key), f"month {key}")


def require_months(spark: SparkSession, root: str, keys: Iterable[RunKey]) -> None:
    """Raise ``FileNotFoundError`` that names the months a table lacks. Folders are listed, no file
    is opened."""
    there = current_months(spark, root)
    absent = [str(key) for key in keys if key not in there]
    if absent:
        raise FileNotFoundError(f"no input for months {', '.join(absent)}: {root}")


def read_table(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """The current version of all months of a table, with ``year`` and ``month``.

    Columns added in later months are NULL in earlier ones. The columns are known from the marks of
    the months, or from ``schema`` (which may have the partition columns); only months without a
    mark have their footers merged, in one distributed job.
    """
    months = current_months(spark, root)
    marked = [m for m in months.values() if m.version is not None]
    emptied = not months and Store(spark, root).exists(f"{root}/{MARKS}")
    if emptied and schema is None:
        raise FileNotFoundError(f"no input for the whole table: {root}")
    if not marked and not emptied:
        reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", True)
        return _read(reader.parquet, root, "the whole table")
    data = written_schema(spark, marked) if schema is None else schema
    columns = T.StructType([f for f in data.fields if f.name not in MONTH_KEYS])
    for key in MONTH_KEYS:
        columns = columns.add(key, T.IntegerType())
    if emptied:
        return spark.createDataFrame([], columns)
    paths = [m.path for m in marked]
    versions = spark.read.schema(columns.add(VERSION, T.StringType())).option("basePath", root).parquet(*paths)
    versions = versions.drop(VERSION)
    plain = [m.path for m in months.values() if m.version is None]
    if not plain:
        return versions
    reader = spark.read.option("basePath", root)
    reader = reader.schema(versions.schema) if schema is not None else reader.option("mergeSchema", True)
    return versions.unionByName(reader.parquet(*plain), allowMissingColumns=True)
