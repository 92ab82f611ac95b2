"""File listings as frames: one row per file, without opening any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import MONTH_KEYS
from tidemark.sources.facts import _read
from tidemark.sources.versions import VERSION, current_months

# The schema of Spark's binary file source, of which the content is never asked for.
FILES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path`` and ``modified`` of every data file below a path."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = _read(reader.load, path, "the file listing")
    return files.select("path", F.col("modificationTime").alias("modified"))


def list_months(spark: SparkSession, root: str) -> DataFrame:
    """``year``, ``month`` and ``modified`` of every data file of the current months of a table.

    Taken from the paths, since a table without rows has no partition columns to discover.
    """
    def key(group: int):
        return F.regexp_extract("path", r"/year=(\d+)/month=(\d+)/", group).try_cast("int")

    year, month = MONTH_KEYS
    files = list_files(spark, root).select(
        key(1).alias(year),
        key(2).alias(month),
        F.regexp_extract("path", rf"/{VERSION}=([^/]+)/", 1).alias("version"),
        "modified",
    )
    current = [(k.year, k.month, m.version or "") for k, m in current_months(spark, root).items()]
    shape = f"{year} int, {month} int, version string"
    return files.join(F.broadcast(spark.createDataFrame(current, shape)), [year, month, "version"]).drop("version")
