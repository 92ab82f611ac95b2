"""Binary files in the shared folder, read and written by tasks, and small frame helpers."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The characters of ASCII white space, as a class body for the regular expressions of Spark.
SPACE = r"\x20\x09-\x0D"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def file_system(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a path or URI and the path within it; works in any task."""
    uri = re.sub(r"^file:/+", "/", uri).replace("s3a://", "s3://", 1)
    return pa.fs.FileSystem.from_uri(uri)


def open_new(folder: str, stem: str, suffix: str) -> tuple[str, pa.NativeFile]:
    """A new file that no other attempt of the same task shares.

    A task that is run again writes another file. Only files that a finished task has returned
    count, so what a lost attempt leaves behind is never read.
    """
    uri = f"{folder.rstrip('/')}/{stem}-{uuid.uuid4().hex}{suffix}"
    system, path = file_system(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return uri, system.open_output_stream(path, compression=None)


def open_old(uri: str) -> pa.NativeFile:
    system, path = file_system(uri)
    return system.open_input_file(path)


def text_of(column: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(f"`{column}`"), F.lit(""))


def unpack(batch: pa.RecordBatch, text: str | None = None) -> Iterator[tuple]:
    """The rows of a batch; the column ``text`` as UTF-8 bytes."""
    columns = []
    for name in batch.schema.names:
        column = batch.column(name)
        columns.append((column.cast(pa.binary()) if name == text else column).to_pylist())
    return zip(*columns)


def pack(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def spread(files: DataFrame, key: str) -> DataFrame:
    """One row, such as a file to read, per task."""
    return files.repartitionByRange(max(1, files.count()), key)
