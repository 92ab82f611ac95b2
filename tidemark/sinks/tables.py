"""Sinks: replaceable months, the quarantine, full refreshes and catalog tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import MONTH_KEYS, RunKey, struct_of
from tidemark.sources.facts import read_table
from tidemark.sources.versions import (
    VERSION,
    current_month,
    current_months,
    discard_version,
    link_marks,
    month_path,
    new_version,
    switch_all,
    switch_month,
    tidy_all,
    tidy_month,
    version_path,
)

QUARANTINE_KEYS = T.StructType(
    [
        T.StructField("layer", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("rule", T.StringType()),
    ]
)
# Bounds the size of a file without limiting how many tasks write; not where a number of files is
# asked for.
MAX_RECORDS_PER_FILE = 5_000_000
# Folders that one task writes side by side. Only rows of further ones are sorted by folder.
OPEN_FOLDERS = 32
_OPEN_FOLDERS = "spark.sql.maxConcurrentOutputFileWriters"
# So many rejects, if they are such a share of a month, are written where they are.
MANY_REJECTS = 1_000_000
MANY_SHARE = 0.25


@contextmanager
def _folders_side_by_side(spark: SparkSession) -> Iterator[None]:
    """Writes by folder keep a file open for each instead of sorting a task's rows, which takes memory for
    all of them. A number that the session sets itself is left as it is."""
    if int(spark.conf.get(_OPEN_FOLDERS)):
        yield
        return
    spark.conf.set(_OPEN_FOLDERS, OPEN_FOLDERS)
    try:
        yield
    finally:
        spark.conf.unset(_OPEN_FOLDERS)


def _overwrite(df: DataFrame, path: str, files: int | None, *partitions: str) -> None:
    writer = (df.repartition(files) if files else df).write.mode("overwrite")
    if not files:
        writer = writer.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    if partitions:
        writer = writer.partitionBy(*partitions)
    with _folders_side_by_side(df.sparkSession):
        writer.parquet(path)


def write_version(df: DataFrame, root: str, key: RunKey, version: str, files: int | None = None) -> None:
    """Write a month's rows where nobody looks for them before ``switch_month``."""
    _overwrite(df, version_path(root, key, version), files)


def replace_month(df: DataFrame, root: str, key: RunKey, files: int | None = None) -> None:
    """Replace one (year, month) of a table in one step; running it again gives the same table.

    Every task writes its own file unless ``files`` asks for a number.
    """
    spark, version = df.sparkSession, new_version()
    try:
        write_version(df, root, key, version, files)
        switch_month(spark, root, key, version, df.schema)
    except Exception:
        discard_version(spark, root, key, version)
        raise
    tidy_month(spark, root, key)


def padded(column: str, digits: int) -> Column:
    """What ``%0<digits>d`` makes of a whole number. Only numbers that are more than a digit short or too
    long, negative or NULL are formatted, which takes longer than the rest of a row does."""
    number = F.col(column)
    text, least = number.cast("string"), 10 ** (digits - 1)
    return (
        F.when(number.between(least, 10 * least - 1), text)
        .when(number.between(least // 10, least - 1), F.concat(F.lit("0"), text))
        .otherwise(F.format_string(f"%0{digits}d", column))
    )


def replace_all_months(df: DataFrame, root: str) -> None:
    """Replace a whole (year, month) table by ``df``, which has both columns, in one step.

    The directories are named as ``replace_month`` names them, so that months can be replaced
    afterwards. Months that ``df`` does not have leave the table.
    """
    spark, version = df.sparkSession, new_version()
    year, month = MONTH_KEYS
    named = df.withColumns({
        year: padded(year, 4),
        month: padded(month, 2),
        VERSION: F.lit(version),
    })
    # Nothing is overwritten: the version is new, and folders of others are left alone.
    writer = named.write.mode("append").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    with _folders_side_by_side(spark):
        writer.partitionBy(*MONTH_KEYS, VERSION).parquet(root)
    switch_all(spark, root, version, df.drop(*MONTH_KEYS).schema)
    tidy_all(spark, root)


def _layer(root: str, layer: str) -> str:
    return f"{root}/layer={layer}"


def many_rejects(rows: int, landed: int) -> bool:
    """Whether rejects are so many that the files of the tasks that find them have a sensible size."""
    return rows >= MANY_REJECTS and rows >= MANY_SHARE * landed


def replace_quarantine(
    rejects: DataFrame, root: str, layer: str, key: RunKey, version: str | None = None, many: bool = False
) -> None:
    """Replace all rejects of one layer and month, split by ``rule``.

    The replaced path is the month, above the rules, so a rule that no longer rejects anything
    leaves nothing behind. The rebalance gathers each rule into files of a sensible size, and
    adaptive execution splits a rule that holds most of the rows. ``many`` rejects are not shuffled:
    every task writes what it finds, as for the facts. With ``version``, the rejects are written for a load that makes that version current itself.
    """
    spark, table = rejects.sparkSession, _layer(root, layer)
    written = version or new_version()
    path = version_path(table, key, written)
    _overwrite(rejects if many else rejects.hint("rebalance", F.col("rule")), path, None, "rule")
    if version is None:
        switch_month(spark, table, key, written, rejects.drop("rule").schema)
        tidy_month(spark, table, key)


def write_rule(rejects: DataFrame, root: str, layer: str, key: RunKey, rule: str, version: str) -> None:
    """Write the rejects of one rule for a load. They are written where they are, with no shuffle or
    sort: meant for rejects that are already spread over the tasks, like replicated copies."""
    _overwrite(rejects, f"{version_path(_layer(root, layer), key, version)}/rule={rule}", None)


def link_quarantine(spark: SparkSession, root: str, layer: str, facts: str) -> None:
    """Let the months of a layer's rejects switch together with its facts."""
    link_marks(spark, _layer(root, layer), facts)


def tidy_quarantine(spark: SparkSession, root: str, layer: str, key: RunKey) -> None:
    tidy_month(spark, _layer(root, layer), key)


def discard_quarantine(spark: SparkSession, root: str, layer: str, key: RunKey, version: str) -> None:
    discard_version(spark, _layer(root, layer), key, version)


def read_quarantine(
    spark: SparkSession, root: str, layer: str, schema: T.StructType | None = None
) -> DataFrame:
    """The rejects of one layer with ``layer``, ``year``, ``month`` and ``rule``.

    Pass the schema of the data to read a layer in which nothing was ever rejected.
    """
    reader = spark.read.option("basePath", root).option("mergeSchema", schema is None)
    if schema is not None:
        reader = reader.schema(struct_of(schema, QUARANTINE_KEYS))
    months = current_months(spark, _layer(root, layer)).values()
    paths = [m.path for m in months if m.version is not None]
    plain = [m.path for m in months if m.version is None]
    if not paths and not plain and schema is not None:
        return spark.createDataFrame([], struct_of(schema, QUARANTINE_KEYS))
    frames = [reader.parquet(*group).drop(VERSION) for group in (paths, plain) if group]
    frames = frames or [reader.parquet(_layer(root, layer))]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_month_rejects(spark: SparkSession, root: str, layer: str, key: RunKey) -> DataFrame | None:
    """The rejects of one layer and month with their ``rule``; None if there are none."""
    month = current_month(spark, _layer(root, layer), key)
    if month is None or not count_rules(spark, month.path):
        return None
    return spark.read.option("mergeSchema", True).parquet(month.path)


def count_rows(spark: SparkSession, path: str) -> int:
    """Rows below a path; no column is read."""
    return spark.read.parquet(path).count()


def count_rules(spark: SparkSession, path: str) -> dict[str, int]:
    """Rows below a path per ``rule``; no column is read."""
    rejects = spark.read.schema("rule string").parquet(path)
    return {row["rule"]: row["count"] for row in rejects.groupBy("rule").count().collect()}


def count_month(spark: SparkSession, root: str, key: RunKey) -> int:
    return count_rows(spark, month_path(spark, root, key))


def count_rejects(spark: SparkSession, root: str, layer: str, key: RunKey) -> dict[str, int]:
    """Rejects of one layer and month per rule."""
    month = current_month(spark, _layer(root, layer), key)
    return count_rules(spark, month.path) if month else {}


def replace_table(df: DataFrame, path: str, files: int | None = None) -> None:
    """Full refresh of a table."""
    _overwrite(df, path, files)


def _quoted_part(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _quoted(name: str) -> str:
    return ".".join(_quoted_part(part) for part in name.split("."))


_ROOT = "tidemark.root"
_MONTH = "tidemark.month."


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _define(spark: SparkSession, name: str, path: str, schema: T.StructType, partitions: tuple[str, ...]) -> bool:
    """Define an external table, or add the columns it lacks to its definition; whether it is new.

    Only a table of that name over other files, or with a column of another type, is dropped first.
    """
    table = _quoted(name)
    if spark.catalog.tableExists(table):
        known = {f.name: f.dataType for f in spark.table(table).schema.fields}
        same = all(known.get(f.name, f.dataType) == f.dataType for f in schema.fields)
        if same and _properties(spark, name).get(_ROOT) == path:
            new = [f for f in schema.fields if f.name not in known]
            if new:
                spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_columns(new)})")
            return False
        drop_table(spark, name)
    by = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
    spark.sql(
        f"CREATE TABLE {table} ({_columns(schema.fields)}) USING parquet {by} LOCATION {_literal(path)} "
        f"TBLPROPERTIES ({_literal(_ROOT)} = {_literal(path)})"
    )
    return True


def _columns(fields: list[T.StructField]) -> str:
    return ", ".join(f"{_quoted_part(f.name)} {f.dataType.simpleString()}" for f in fields)


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_quoted(name)}").collect()}


def register_table(
    spark: SparkSession, name: str, path: str, partitions: tuple[str, ...] = ()
) -> None:
    """Publish the files under ``path`` as an external table, with all their columns and months."""
    if partitions:
        publish_months(spark, name, path)
        return
    _define(spark, name, path, spark.read.parquet(path).schema, ())
    spark.catalog.refreshTable(_quoted(name))


def publish_months(spark: SparkSession, name: str, root: str) -> list[RunKey]:
    """Bring the catalog table ``name`` up to date with a (year, month) table; the months it touched.

    Each month's partition points at the folder of its current version. Which version that is stands
    in the table's properties, so that only months that changed are added, moved or dropped: no file
    is listed, and a table that exists is never absent in between. Readers see each month switch
    with one statement.
    """
    table = _quoted(name)
    schema = read_table(spark, root).schema
    months = {key: month.path for key, month in current_months(spark, root).items()}
    if _define(spark, name, root, schema, MONTH_KEYS):
        published = {}
    else:
        places = _properties(spark, name)
        published = {
            RunKey(*map(int, k.removeprefix(_MONTH).split("-"))): path
            for k, path in places.items() if k.startswith(_MONTH)
        }

    def part(key: RunKey) -> str:
        return f"PARTITION (year = {key.year}, month = {key.month})"

    changed = [k for k, path in months.items() if published.get(k) != path]
    gone = [k for k in published if k not in months]
    new = [f"{part(k)} LOCATION {_literal(months[k])}" for k in changed if k not in published]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(new)}")
    for key in changed:
        if key in published:
            spark.sql(f"ALTER TABLE {table} {part(key)} SET LOCATION {_literal(months[key])}")
    for key in gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {part(key)}")
    if changed:
        entries = ", ".join(f"{_literal(f'{_MONTH}{k}')} = {_literal(months[k])}" for k in changed)
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({entries})")
    if gone:
        entries = ", ".join(_literal(f"{_MONTH}{k}") for k in gone)
        spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ({entries})")
    spark.catalog.refreshTable(table)
    return sorted(changed + gone)


def publish_month(spark: SparkSession, name: str, root: str, key: RunKey) -> None:
    """Make a loaded month of a (year, month) table visible under ``name``, which must be there."""
    if current_month(spark, root, key) is None:
        raise FileNotFoundError(f"no input for month {key}: {root}")
    publish_months(spark, name, root)


def drop_table(spark: SparkSession, name: str) -> None:
    """Remove a table's definition; the files of an external table stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
