"""Exact duplicates by a content sort, with DataFrame functions only.

Sampled splitters range-partition the rows by their normalised content; an external sort puts
equal contents next to each other; neighbours are compared in full, and the copy with the smallest
identifier stays. A row's place in the order is the beginning of its content, then a hash of all of
it: the samples that choose the splitters stay small however long the texts are, and contents that
begin alike are still spread. The hash only orders rows; the comparison of neighbours decides.

A content with more copies than an even share of a partition would fill one task. Such contents are
found first by counting hashes; their rows are spread over several runs, and the heads of the runs,
few per content, go through the same sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import SPACE
from tidemark.sources.scratch import scratch_path, settle

BEGINNING = 64  # characters
# Single spaces are left alone, so ordinary prose is scanned but not rebuilt.
_UNEVEN_SPACE = rf"[\x09-\x0D][{SPACE}]*+|\x20[{SPACE}]++"


def normalised(text: Column) -> Column:
    """Runs of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _UNEVEN_SPACE, " ")


def crowded(hashes: DataFrame, share: int) -> DataFrame:
    """``hash`` and number of ``runs`` of contents with more than ``share`` copies."""
    counts = hashes.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") > share).select("hash", F.ceil(F.col("n") / share).alias("runs"))


def content_sorted(rows: DataFrame, text: Column, *runs: str) -> DataFrame:
    """Rows partitioned by ranges of (beginning, hash, runs); ``content`` is put in afterwards, so
    that each text travels once."""
    placed = rows.repartitionByRange("beginning", "hash", *runs)
    return placed.withColumn("content", normalised(text))


def exact_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row of ``docs`` as the struct ``row``, with the copy that stays and its group.

    Texts are equal when identical after :func:`normalised`; a null text equals an empty one.
    Columns: ``row``, ``keep_id`` (smallest identifier of equal texts; null ones come last),
    ``group_size``, ``kept`` (exactly one row of a group, also where identifiers repeat) and
    ``text_sha256`` of the normalised text. An empty table gives no rows; further columns of
    ``docs``, whatever their names, only travel inside ``row``.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = max(1, docs.count() // partitions)
    raw = F.col("row")[text]
    rows = docs.select(F.struct("*").alias("row")).withColumn("hash", F.xxhash64(normalised(raw)))
    # At most ``partitions`` contents have more copies than an even share, so this is broadcast.
    hot = settle(crowded(rows.select("hash"), share), scratch_path(spark))
    keyed = rows.select(
        "row",
        "hash",
        F.substring(normalised(raw), 1, BEGINNING).alias("beginning"),
        F.xxhash64(F.monotonically_increasing_id()).alias("dealt"),
    )
    if hot.limit(1).count() == 0:
        return _found(_in_runs(keyed.drop("dealt"), id, text))
    run = F.coalesce(F.pmod("dealt", "runs"), F.lit(0).cast("bigint"))
    keyed = keyed.join(F.broadcast(hot), "hash", "left").withColumn("run", run).drop("dealt")
    # Dealt once: both uses below have to see each row in the same run.
    crowd = settle(keyed.where(F.col("runs").isNotNull()), scratch_path(spark))
    # Two runs per partition at most, so the resolved heads are broadcast, too.
    heads = _in_runs(crowd, id, text, "run").where("first")
    resolved = settle(_resolved(heads, text), scratch_path(spark))
    found = _in_runs(crowd, id, text, "run").join(F.broadcast(resolved), ["hash", "run", "text_sha256"], "left")
    alone = _in_runs(keyed.where(F.col("runs").isNull()).drop("run"), id, text)
    return _found(alone).unionByName(
        found.select(
            "row",
            F.when(F.col("winner").isNull(), F.col("run_keep")).otherwise(F.col("all_keep")).alias("keep_id"),
            F.coalesce("all_size", "run_size").alias("group_size"),
            (F.col("first") & F.coalesce("winner", F.lit(True))).alias("kept"),
            "text_sha256",
        )
    )


def _found(compared: DataFrame) -> DataFrame:
    return compared.select(
        "row",
        F.col("run_keep").alias("keep_id"),
        F.col("run_size").alias("group_size"),
        F.col("first").alias("kept"),
        "text_sha256",
    )


def _in_runs(keyed: DataFrame, id: str, text: str, *run: str) -> DataFrame:
    """Compare neighbours; the window's partitions are the rows whose full contents are equal.

    The ranges are a subset of the window's keys, so the window needs no exchange of its own.
    """
    equal = Window.partitionBy("beginning", "hash", *run, "content")
    ordered = equal.orderBy(F.col("id").asc_nulls_last())
    return (
        content_sorted(keyed, F.col("row")[text], *run)
        .withColumn("id", F.col("row")[id])
        .withColumn("first", F.row_number().over(ordered) == 1)
        .withColumn("run_keep", F.first("id").over(ordered))
        .withColumn("run_size", F.count(F.lit(1)).over(equal))
        .withColumn("text_sha256", F.sha2("content", 256))
        .drop("id")
    )


def _resolved(heads: DataFrame, text: str) -> DataFrame:
    """Per run of a crowded content: its identifier, size and whether the run has the row to keep."""
    equal = Window.partitionBy("beginning", "hash", "content")
    ordered = equal.orderBy(F.col("run_keep").asc_nulls_last(), "run")
    runs = heads.select(
        F.col("row")[text].alias("raw"), "beginning", "hash", "run", "run_keep", "run_size", "text_sha256"
    )
    return (
        content_sorted(runs, F.col("raw"))
        .withColumn("winner", F.row_number().over(ordered) == 1)
        .withColumn("all_keep", F.first("run_keep").over(ordered))
        .withColumn("all_size", F.sum("run_size").over(equal))
        .select("hash", "run", "text_sha256", "winner", "all_keep", "all_size")
    )


def drop_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, unchanged."""
    return exact_duplicates(docs, id, text).where("kept").select("row.*")
