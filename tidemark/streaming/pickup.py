"""Incremental pickup of landed files, and the ledger of months already loaded.

Months are independent: one that cannot be loaded is reported at the end and tried again by the
next call, and the others are loaded and entered all the same.

Only file listings flow through here, one row per file; the facts are read by the loads that each
new month starts. A month may be one file or a directory of part files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.paths import month_of_path
from tidemark.model import MONTH_FILE_FORMAT, Layout, RunKey
from tidemark.sources.facts import _read
from tidemark.sources.listing import FILES

LEDGER = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("processed_at", T.TimestampType()),
    ]
)
_STRAYS = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("modified", T.TimestampType())]
)
_OPTIONS = {"recursiveFileLookup": "true", "pathGlobFilter": "*.parquet"}
# The name of a landed month as a pattern of format_string.
_NAME = MONTH_FILE_FORMAT.replace("{year:04d}", "%04d").replace("{month:02d}", "%02d")

Load = Callable[[RunKey], object]
Finish = Callable[[list[RunKey]], object]


class LoadError(RuntimeError):
    """Months that could not be loaded; ``failed`` has the error of each, ``loaded`` the others."""

    def __init__(self, failed: dict[RunKey, Exception], loaded: list[RunKey]) -> None:
        described = "; ".join(f"{key}: {error}" for key, error in failed.items())
        super().__init__(f"months not loaded: {described}")
        self.failed, self.loaded = failed, loaded


def _with_month(listing: DataFrame, landing: str) -> DataFrame:
    """(path, modified, year, month). The key is looked for below the landing directory only, and
    it is NULL unless the file or directory there has the name under which a month is loaded."""
    below = F.substring_index("path", f"/{landing}/", -1)
    name = F.substring_index(below, "/", 1)
    year, month = month_of_path(name)
    ours = name == F.format_string(_NAME, year, month)
    return listing.select(
        "path",
        F.col("modificationTime").alias("modified"),
        F.when(ours, year).alias("year"),
        F.when(ours, month).alias("month"),
    )


def landed_files(spark: SparkSession, layout: Layout) -> DataFrame:
    """All files in landing with their modification time and month (NULL if the path has none)."""
    listing = spark.read.format("binaryFile").options(**_OPTIONS).load(layout.landing_root)
    return _with_month(listing, layout.landing)


def _entries(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return _read(spark.read.schema(schema).parquet, path, "the ledger")
    except FileNotFoundError:
        return spark.createDataFrame([], schema)


def _loaded(spark: SparkSession, layout: Layout) -> DataFrame:
    ledger = _entries(spark, layout.ledger, LEDGER)
    return ledger.where(F.col("processed_at").isNotNull())


def failed_months(spark: SparkSession, layout: Layout) -> DataFrame:
    """(path, modified, year, month) of months that were tried and never loaded since; the ledger
    has them without a processing time."""
    ledger = _entries(spark, layout.ledger, LEDGER)
    tried = ledger.where(F.col("processed_at").isNull())
    return tried.select(
        F.lit(None).cast("string").alias("path"), "modified", "year", "month"
    ).distinct().join(_loaded(spark, layout), ["year", "month", "modified"], "left_anti").select(
        "path", "modified", "year", "month"
    )


def pending_months(files: DataFrame, layout: Layout, force: bool = False) -> DataFrame:
    """(year, month, modified) of the months in ``files`` that the ledger does not have yet.

    A file changed since its month was loaded makes the month pending again; ``force`` makes all
    of them pending.
    """
    months = (
        files.where(F.col("month").isNotNull())
        .groupBy("year", "month")
        .agg(F.max("modified").alias("modified"))
    )
    if force:
        return months
    loaded = _loaded(files.sparkSession, layout)
    return months.join(loaded, ["year", "month", "modified"], "left_anti")


def _quarantine_strays(files: DataFrame, layout: Layout) -> None:
    """List the files without a month in the quarantine, each once."""
    path = layout.stray_files
    known = _entries(files.sparkSession, path, _STRAYS)
    strays = files.where(F.col("month").isNull()).select("path", "modified")
    new = strays.join(known, ["path", "modified"], "left_anti")
    if not new.isEmpty():
        new.write.mode("append").parquet(path)


def _load_pending(
    files: DataFrame, layout: Layout, load: Load, finish: Finish | None, force: bool
) -> tuple[list[RunKey], dict[RunKey, Exception]]:
    """Try each pending month once, oldest first, and enter it in the ledger.

    ``finish`` gets the loaded months once, before they are entered, so that they are pending again
    if it fails. The driver sees calendar months only.
    """
    spark = files.sparkSession
    _quarantine_strays(files, layout)
    months = pending_months(files, layout, force).orderBy("year", "month").collect()
    modified = {RunKey(m["year"], m["month"]): m["modified"] for m in months}
    loaded: list[RunKey] = []
    failed: dict[RunKey, Exception] = {}
    for key in modified:
        try:
            load(key)
            loaded.append(key)
        except Exception as error:  # whatever is wrong with one month, the others go on
            failed[key] = error
    if finish is not None and loaded:
        try:
            finish(loaded)
        except Exception as error:
            failed |= dict.fromkeys(loaded, error)
            loaded = []
    if modified:
        entries = spark.createDataFrame(
            [(key.year, key.month, at, key in failed) for key, at in modified.items()],
            "year int, month int, modified timestamp, failed boolean",
        )
        time = F.when(~F.col("failed"), F.current_timestamp())
        entries.select("year", "month", "modified", time.alias("processed_at")).coalesce(
            1
        ).write.mode("append").parquet(layout.ledger)
    return loaded, failed


def _result(loaded: list[RunKey], failed: dict[RunKey, Exception]) -> list[RunKey]:
    if failed:
        raise LoadError(failed, loaded) from next(iter(failed.values()))
    return loaded


def pick_up_new_files(
    spark: SparkSession,
    layout: Layout,
    checkpoint: str,
    load: Load,
    force: bool = False,
    finish: Finish | None = None,
) -> list[RunKey]:
    """Load the months of the files that arrived since the last call, then stop.

    The stream's checkpoint remembers the files; the ledger keeps a month from being loaded twice,
    and remembers months that failed, which are tried again first. ``finish`` is called with the
    months each batch loaded, for work that is done once for all of them. Failures are raised as
    one ``LoadError`` when every month has been tried.
    """
    loaded: list[RunKey] = []
    failed: dict[RunKey, Exception] = {}

    def on_batch(batch: DataFrame, _: int) -> None:
        done, wrong = _load_pending(batch, layout, load, finish, force)
        loaded.extend(done)
        for key in done:
            failed.pop(key, None)
        failed.update(wrong)

    again = failed_months(spark, layout)
    if not again.isEmpty():
        on_batch(again, -1)
    listing = (
        spark.readStream.format("binaryFile").schema(FILES).options(**_OPTIONS)
        .load(layout.landing_root)
    )
    query = (
        _with_month(listing, layout.landing)
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return _result(loaded, failed)


def catch_up(
    spark: SparkSession,
    layout: Layout,
    load: Load,
    force: bool = False,
    finish: Finish | None = None,
) -> list[RunKey]:
    """Load every landed month the ledger lacks, including files replaced under their old name,
    which a file stream does not report again. ``finish`` and failures as above."""
    files = landed_files(spark, layout)
    return _result(*_load_pending(files, layout, load, finish, force))
