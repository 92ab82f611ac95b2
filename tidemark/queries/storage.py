"""Sources, sinks, contracts and file pickup: tables are written, replaced and read back."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import month_of_path
from tidemark.model import (
    MONTH_FILE_FORMAT,
    OUT_HOUR_TRIPS,
    PICKUP_TIME,
    RULE_STRAY,
    RULE_TIMES,
    RunKey,
)
from tidemark.operators import rules
from tidemark.operators.contracts import (
    ContractError,
    check_contract,
    check_types,
    conform,
    drift_report,
)
from tidemark.plans.raw import LAYER as RAW_LAYER
from tidemark.plans.raw import load_raw, with_audit
from tidemark.plans.silver import business_rules
from tidemark.queries.layers import fresh_layout, write_zones
from tidemark.queries.marts import event_hours
from tidemark.queries.registry import query
from tidemark.queries.rows import trip_id
from tidemark.queries.views import MONTH, sql_trips, sql_zones, table, trips
from tidemark.sinks import tables
from tidemark.sources.facts import (
    SOURCE_FILE,
    read_month_file,
    read_partition,
    read_table,
    require_months,
    with_source,
)
from tidemark.sources.files import Store
from tidemark.sources.lookup import read_lookup
from tidemark.sources.scratch import scratch_path
from tidemark.sources.versions import current_months
from tidemark.streaming import pickup


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def _write_by_month(orders: DataFrame, root: str, mode: str = "errorifexists") -> None:
    """Order months as ``year=YYYY/month=MM`` directories, each gathered into few files."""
    at = F.col("o_orderdate")
    (
        orders.withColumns({"year": F.date_format(at, "yyyy"), "month": F.date_format(at, "MM")})
        .hint("rebalance", F.col("year"), F.col("month"))
        .write.mode(mode).partitionBy("year", "month").parquet(root)
    )


# --- sources ------------------------------------------------------------------------------------

@query("month_file_scan", """
SELECT o_orderkey, o_orderstatus, o_totalprice, TRUE AS has_source FROM orders""")
def month_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed month with the file name of each row, taken at the scan."""
    layout = fresh_layout(spark)
    path = layout.landing_file(MONTH)
    _orders(spark, sf_dir).write.parquet(path)
    return with_source(read_month_file(spark, path, MONTH)).select(
        "o_orderkey", "o_orderstatus", "o_totalprice",
        F.col(SOURCE_FILE).endswith(".parquet").alias("has_source"),
    )


@query("partition_scan", """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate < TIMESTAMP '1996-04-01'""")
def partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark)
    _write_by_month(_orders(spark, sf_dir), root)
    return read_partition(spark, root, MONTH).drop("o_custkey", "o_orderdate", "o_orderpriority")


@query("table_scan_evolved", """
SELECT o_orderkey, CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS o_orderpriority,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
FROM orders""")
def table_scan_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that only later months have is NULL in the earlier ones."""
    root = scratch_path(spark)
    orders = _orders(spark, sf_dir)
    early = F.year("o_orderdate") < 1998
    _write_by_month(orders.where(early).drop("o_orderpriority"), root)
    _write_by_month(orders.where(~early), root, "append")
    return read_table(spark, root).select("o_orderkey", "o_orderpriority", "year", "month")


@query("csv_lookup", f"""
WITH {sql_zones()}, served AS (SELECT c_nationkey AS id, count(*) AS customers FROM customer GROUP BY 1)
SELECT zones.id AS location, borough, zone, CAST(coalesce(customers, 0) AS BIGINT) AS customers
FROM zones LEFT JOIN served ON zones.id = served.id""")
def csv_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup read back from CSV with declared types, and the customers in each zone."""
    layout = fresh_layout(spark)
    write_zones(spark, sf_dir, layout, partial=False)
    lookup = read_lookup(spark, layout.lookup)
    served = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("customers")
    )
    return lookup.frame.join(served, F.col("LocationID") == F.col("c_nationkey"), "left").select(
        F.col("LocationID").alias("location"), F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
        F.coalesce("customers", F.lit(0).cast("bigint")).alias("customers"),
    )


@query("input_guard", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       TRUE AS found, count(*) AS orders FROM orders GROUP BY 1, 2
UNION ALL SELECT 2002, 1, max(o_orderdate) >= TIMESTAMP '2002-01-01', 0 FROM orders""")
def input_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every month that has input, counted in one scan, and one that has none: an absent month is an
    error that names it. Which months are there is known from their folders alone."""
    root = scratch_path(spark)
    orders = _orders(spark, sf_dir)
    at = F.col("o_orderdate")
    tables.replace_all_months(
        orders.withColumns({"year": F.year(at), "month": F.month(at)}).hint("rebalance", F.col("year"), F.col("month")),
        root,
    )
    guarded, named = [*current_months(spark, root), RunKey(2002, 1)], ""
    try:
        require_months(spark, root, guarded)
    except FileNotFoundError as error:
        named = str(error)
    found = [(key.year, key.month, str(key) not in named) for key in guarded]
    counted = read_table(spark, root).groupBy("year", "month").agg(F.count(F.lit(1)).alias("orders"))
    months = spark.createDataFrame(found, "year int, month int, found boolean")
    return months.join(counted, ["year", "month"], "left").select(
        "year", "month", "found", F.coalesce("orders", F.lit(0).cast("bigint")).alias("orders")
    )


# --- sinks --------------------------------------------------------------------------------------

def _timed_trips(df: DataFrame) -> DataFrame:
    return df.select(*trip_id(), F.col(PICKUP_TIME).alias("pickup"))


@query("replace_month", f"""
WITH {sql_trips()}
SELECT trip_key, line, pickup FROM trips
WHERE pickup >= TIMESTAMP '1996-03-01' AND pickup < TIMESTAMP '1996-04-01'""")
def replace_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month written with every trip, then again with its own trips only."""
    root = scratch_path(spark)
    facts = trips(spark, sf_dir)
    tables.replace_month(facts, root, MONTH)
    own = rules.keep_rows(facts, [rules.month_rule(RULE_STRAY, PICKUP_TIME, MONTH)])
    tables.replace_month(own, root, MONTH)
    return _timed_trips(read_table(spark, root))


@query("quarantine_write", f"""
WITH {sql_trips('l_tax')}
SELECT CASE WHEN passengers = 0 THEN 'faulty_passenger_count' ELSE 'faulty_trip_distance' END AS rule,
       CAST(1996 AS INTEGER) AS year, CAST(3 AS INTEGER) AS month, trip_key, line, pickup
FROM trips WHERE passengers = 0 OR distance = 0""")
def quarantine_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects written by rule, then replaced by a run without the time rule: none of its stay."""
    root = scratch_path(spark)
    facts = trips(spark, sf_dir, "l_tax")
    for active in (business_rules(), [r for r in business_rules() if r.name != RULE_TIMES]):
        rejects = rules.rejected(rules.classify(facts, active))
        tables.replace_quarantine(rejects, root, "silver", MONTH)
    return read_quarantine_rows(spark, root)


def read_quarantine_rows(spark: SparkSession, root: str) -> DataFrame:
    rows = tables.read_quarantine(spark, root, "silver")
    return rows.select("rule", "year", "month", *trip_id(), F.col(PICKUP_TIME).alias("pickup"))


@query("full_refresh", f"""
WITH {sql_trips()} SELECT trip_key, line, pickup FROM trips WHERE dropoff >= pickup""")
def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark)
    facts = trips(spark, sf_dir)
    tables.replace_table(facts, path)
    tables.replace_table(rules.keep_rows(facts, business_rules()[:1]), path)
    return _timed_trips(read_table(spark, path))


@query("single_file_table", """
SELECT event_type AS pu_zone, CAST(hour(ts) AS INTEGER) AS pickup_hour, count(*) AS trips,
       CAST(1 AS BIGINT) AS files
FROM events GROUP BY 1, 2""")
def single_file_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An aggregate table kept in one file; ``files`` counts what was really written."""
    path = scratch_path(spark)
    hours = event_hours(spark, sf_dir).withColumnRenamed(OUT_HOUR_TRIPS, "trips")
    tables.replace_table(hours, path, files=1)
    written = read_table(spark, path).select("*", F.col("_metadata.file_name").alias("file"))
    files = written.agg(F.count_distinct("file").alias("files"))
    return written.select(
        F.col("PUZone").alias("pu_zone"), "pickup_hour", "trips", files.scalar().alias("files")
    )


@query("published_table", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       count(*) AS orders, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY 1, 2""")
def published_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table over monthly files, queried by name."""
    root, name = scratch_path(spark), f"orders_{uuid.uuid4().hex}"
    _write_by_month(_orders(spark, sf_dir), root)
    tables.register_table(spark, name, root, ("year", "month"))
    return spark.table(name).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


# --- contracts and audit columns ----------------------------------------------------------------

def _non_null(column: str) -> Column:
    return F.count(F.col(f"`{column}`")).alias(column)


@query("schema_drift", """
SELECT 'o_orderstatus' AS "column", 'missing' AS change, 0 AS non_null FROM orders GROUP BY 1, 2
UNION ALL SELECT 'o_custkey', 'type', count(o_custkey) FROM orders
UNION ALL SELECT 'order_flag', 'added', count(o_orderstatus) FROM orders""")
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a renamed and a narrowed column against their contract, and the values the
    drifted columns hold."""
    orders = _orders(spark, sf_dir)
    drifted = orders.withColumn("o_custkey", F.col("o_custkey").cast("int")).withColumnRenamed(
        "o_orderstatus", "order_flag"
    )
    report = drift_report(drifted, orders.schema)
    counts = (
        drifted.agg(*[_non_null(c) for c in drifted.columns])
        .unpivot([], drifted.columns, "column", "non_null")
    )
    return report.join(counts, "column", "left").select(
        "column", "change", F.coalesce("non_null", F.lit(0).cast("bigint")).alias("non_null")
    )


@query("contract_check", """
SELECT 'added' AS change, TRUE AS passes, count(*) AS orders FROM orders
UNION ALL SELECT 'narrower', TRUE, count(*) FROM orders
UNION ALL SELECT 'missing', FALSE, 0
UNION ALL SELECT 'wrong case', FALSE, 0
UNION ALL SELECT 'wrong type', FALSE, 0""")
def contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders changed in five ways, written, read back and held to the contract of the table."""
    orders = _orders(spark, sf_dir)
    key = F.col("o_orderkey")
    changed = {
        "added": orders.withColumn("new_col", key),
        "narrower": orders.withColumn("o_orderkey", key.cast("int")),
        "missing": orders.drop("o_orderkey"),
        "wrong case": orders.withColumnRenamed("o_orderkey", "O_OrderKey"),
        "wrong type": orders.withColumn("o_orderkey", key.cast("string")),
    }

    def checked(change: str, landed: DataFrame) -> DataFrame:
        path = f"{scratch_path(spark)}/{change.replace(' ', '_')}"
        landed.write.parquet(path)
        found = conform(read_month_file(spark, path, MONTH), orders.schema)
        try:
            check_contract(found, orders.schema, change)
            check_types(found, orders.schema, change)
            passes, rows = True, found
        except ContractError:
            passes, rows = False, found.where(F.lit(False))
        return rows.agg(F.count(F.lit(1)).alias("orders")).select(
            F.lit(change).alias("change"), F.lit(passes).alias("passes"), "orders"
        )

    return reduce(DataFrame.unionAll, [checked(*case) for case in changed.items()])


@query("audit_columns", """
SELECT count(*) AS trips, CAST(1 AS BIGINT) AS ingestion_times, count(*) AS named_sources,
       min(l_shipdate) AS first_dropoff FROM lineitem""")
def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row has the same ingestion time and the name of the file it was read from."""
    path = f"{sf_dir}/lineitem.parquet"
    audited = with_audit(with_source(read_month_file(spark, path, MONTH)))
    return audited.agg(
        F.count(F.lit(1)).alias("trips"),
        F.count_distinct("ingestion_timestamp").alias("ingestion_times"),
        F.count_if(F.col("source_file_name") == "lineitem.parquet").alias("named_sources"),
        F.min("l_shipdate").alias("first_dropoff"),
    )


# --- file pickup --------------------------------------------------------------------------------

def _land_months(spark: SparkSession, sf_dir: str, landing: str) -> None:
    """Orders as they land, one directory per month. Written in one job below ``file=``, then moved to
    the names of landed months."""
    name = F.format_string(
        MONTH_FILE_FORMAT.replace("{year:04d}", "%04d").replace("{month:02d}", "%02d"),
        F.year("o_orderdate"), F.month("o_orderdate"),
    )
    written = scratch_path(spark)
    (
        _orders(spark, sf_dir).withColumn("file", name)
        .hint("rebalance", F.col("file"))
        .write.partitionBy("file").parquet(written)
    )
    store = Store(spark, landing)
    store.make(landing)
    for month in store.names(written):
        if month.startswith("file="):
            store.rename(f"{written}/{month}", f"{landing}/{month.split('=', 1)[1]}")


@query("file_pickup", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       count(*) AS orders
FROM orders GROUP BY 1, 2""")
def file_pickup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New files are picked up by a stream, each month once: the second call adds nothing. The
    ledger's months are joined with the rows found under them."""
    layout = fresh_layout(spark)
    _land_months(spark, sf_dir, layout.landing_root)
    for _ in range(2):
        pickup.pick_up_new_files(spark, layout, f"{layout.base}/_stream", lambda key: None)
    year, month = month_of_path(F.substring_index("_metadata.file_path", "/landing/", -1))
    rows = (
        spark.read.option("recursiveFileLookup", True).parquet(layout.landing_root)
        .select(year.alias("year"), month.alias("month"))
        .groupBy("year", "month").agg(F.count(F.lit(1)).alias("orders"))
    )
    ledger = spark.read.schema(pickup.LEDGER).parquet(layout.ledger).select("year", "month")
    return ledger.join(rows, ["year", "month"])


@query("pickup_load", f"""
WITH {sql_trips()},
landed AS (SELECT *, CASE WHEN pickup < TIMESTAMP '1996-03-01' THEN 2 ELSE 3 END AS month FROM trips),
copies AS (SELECT *, row_number() OVER (
  PARTITION BY trip_key, line, pickup, dropoff, passengers, distance, flag, pu, dof, fare) AS copy
  FROM landed)
SELECT CAST(1996 AS INTEGER) AS year, CAST(month AS INTEGER) AS month,
       CASE WHEN copy > 1 THEN 'dropped_duplicates'
            WHEN pu NOT BETWEEN 1 AND 266 OR dof NOT BETWEEN 1 AND 266 THEN 'dropped_locations'
            WHEN year(pickup) <> 1996 OR month(pickup) <> month THEN 'dropped_stray_timestamps'
            ELSE 'raw' END AS destination, trip_key, line
FROM copies""")
def pickup_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips landed as two months and loaded by the stream that finds them. A file with another
    name lies first among them; it is listed, and no month waits for it."""
    layout = fresh_layout(spark)
    facts = trips(spark, sf_dir)
    early = F.col(PICKUP_TIME) < F.lit("1996-03-01").cast("timestamp_ntz")
    february = RunKey(1996, 2)
    facts.where(early).write.parquet(layout.landing_file(february))
    facts.where(~early).write.parquet(layout.landing_file(MONTH))
    table(spark, sf_dir, "region").write.parquet(f"{layout.landing_root}/other_1996-01.parquet")
    for _ in range(2):
        pickup.pick_up_new_files(
            spark, layout, f"{layout.base}/_stream", lambda key: load_raw(spark, layout, key)
        )
    place = ("year", "month")
    raw = read_table(spark, layout.raw_facts)
    rejects = tables.read_quarantine(spark, layout.quarantine, RAW_LAYER, raw.drop(*place).schema)
    return raw.select(*place, F.lit(RAW_LAYER).alias("destination"), *trip_id()).unionAll(
        rejects.select(*place, F.col("rule").alias("destination"), *trip_id())
    )


@query("repeat_guard", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
FROM orders WHERE year(o_orderdate) >= 1998 GROUP BY 1, 2""")
def repeat_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months already in the ledger are not pending again."""
    layout = fresh_layout(spark)
    _land_months(spark, sf_dir, layout.landing_root)
    files = pickup.landed_files(spark, layout)
    done = pickup.pending_months(files, layout).where(F.col("year") < 1998)
    done.withColumn("processed_at", F.current_timestamp()).write.parquet(layout.ledger)
    return pickup.pending_months(files, layout).select("year", "month")
