"""Intermediate tables, written to the shared folder the cluster names."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.files import Store


class NoSharedFolderError(RuntimeError):
    """The session names no folder that driver and executors share."""


def scratch_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir`` or of ``SparkContext.setCheckpointDir``.

    Where neither is set, the session's warehouse folder: with a local master, as in tests, or if its
    URI names a store that is not a machine's own disk. Otherwise there is no shared folder, which is
    an error: a machine-local folder is never used on a cluster.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        local = re.match(r"local(\[|$)", spark.conf.get("spark.master", ""))
        if not local and re.match(r"file:|(?!\w+:)", warehouse):
            raise NoSharedFolderError("set spark.checkpoint.dir to a folder that all executors share")
        shared = f"{warehouse}/_scratch"
    return f"{shared.rstrip('/')}/tidemark"


def scratch_path(spark: SparkSession) -> str:
    """A new path below the shared folder; no two runs share one."""
    return f"{scratch_root(spark)}/{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete an intermediate folder that :func:`scratch_path` gave."""
    Store(spark, path).delete(path)


def settle(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` and read it back: cuts the lineage at files that survive lost executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
