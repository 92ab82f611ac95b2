"""Trips and zones derived from the test tables, in Spark and in SQL.

A trip is an order line: ordered at pickup, shipped at dropoff, from the customer's nation to the
supplier's. A zone is a nation, its borough the region. The joins are plain equi joins. Spark
broadcasts small sides by itself; larger ones are built as hash tables, per partition or, up to a
measured number of rows, whole, so that the wide lines are never sorted. Adaptive execution splits
hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.model import LOOKUP_COLUMNS, RunKey
from tidemark.operators.lookups import Lookup, check_lookup

MONTH = RunKey(1996, 3)
LEFT_OUT_REGION = "MIDDLE EAST"
# Rows of a join side up to which Spark alone chooses the join.
PLAIN_ROWS = 1_000_000
# Rows of a key and a nation that are broadcast at most, some 64 MB.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _nations(spark: SparkSession, sf_dir: str, name: str, key: str, nation: str) -> DataFrame:
    """Keys and nations of customers or suppliers as the build side of a join, which they are counted for
    from the footers."""
    side = table(spark, sf_dir, name).select(key, nation)
    return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side.hint("shuffle_hash")


def _built(orders: DataFrame, rows: int) -> DataFrame:
    """Orders as the side of the join with the lines that is held in memory, a partition at a time."""
    return orders if rows <= PLAIN_ROWS else orders.hint("shuffle_hash")


def order_lines(
    spark: SparkSession, sf_dir: str, pickup: bool = False, dropoff: bool = False
) -> DataFrame:
    """Order lines with their order; with the pickup and dropoff nation where asked for.

    Customers are joined to the orders before the larger lines are.
    """
    orders = table(spark, sf_dir, "orders")
    rows = orders.count()
    if pickup:
        customer = _nations(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
        orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    lines = table(spark, sf_dir, "lineitem").join(
        _built(orders, rows), F.col("l_orderkey") == F.col("o_orderkey")
    )
    if dropoff:
        supplier = _nations(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
        lines = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return lines


def trip_columns(distance: Column) -> dict[str, Column]:
    """The trip contract over ``order_lines``; ``trip_key`` is a column beyond the contract."""
    c = F.col
    return {
        "trip_key": c("l_orderkey"),
        "VendorID": c("l_linenumber"),
        "tpep_pickup_datetime": c("o_orderdate"),
        "tpep_dropoff_datetime": c("l_shipdate"),
        "passenger_count": F.round(c("l_discount") * 100).cast("bigint"),
        "trip_distance": distance,
        "RatecodeID": c("l_linenumber").cast("bigint"),
        "store_and_fwd_flag": c("l_returnflag"),
        "PULocationID": c("c_nationkey"),
        "DOLocationID": c("s_nationkey"),
        "payment_type": c("l_linenumber").cast("bigint"),
        "fare_amount": c("l_extendedprice"),
        "extra": c("l_discount"),
        "mta_tax": c("l_tax"),
        "tip_amount": c("l_quantity"),
        "tolls_amount": c("l_discount"),
        "improvement_surcharge": c("l_tax"),
        "total_amount": c("o_totalprice"),
        "congestion_surcharge": c("l_discount"),
        "Airport_fee": c("l_tax"),
        "cbd_congestion_fee": c("l_quantity"),
    }


# The columns of ``order_lines`` that trips are made of: fewer than the trips have, some of which repeat.
LINE_COLUMNS = (
    "l_orderkey", "l_linenumber", "l_shipdate", "l_discount", "l_returnflag", "l_extendedprice", "l_tax",
    "l_quantity", "o_orderdate", "o_totalprice", "c_nationkey", "s_nationkey",
)


def select_trips(lines: DataFrame, distance: str = "l_quantity") -> DataFrame:
    """The contract columns that ``lines`` can provide (all of them with both nations joined)."""
    absent = {"PULocationID": "c_nationkey", "DOLocationID": "s_nationkey"}
    columns = {
        name: column
        for name, column in trip_columns(F.col(distance)).items()
        if absent.get(name, "l_orderkey") in lines.columns
    }
    return lines.select(*[column.alias(name) for name, column in columns.items()])


def trips(spark: SparkSession, sf_dir: str, distance: str = "l_quantity") -> DataFrame:
    return select_trips(order_lines(spark, sf_dir, pickup=True, dropoff=True), distance)


def landed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trips as they might be landed: flags missing on some, a second copy of others."""
    flagged = trips(spark, sf_dir, "l_tax").withColumn(
        "store_and_fwd_flag", F.nullif("store_and_fwd_flag", F.lit("A"))
    )
    copies = F.when(F.col("VendorID") == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return flagged.withColumn("_copy", F.explode(copies)).drop("_copy")


def zone_frame(spark: SparkSession, sf_dir: str, partial: bool = False) -> DataFrame:
    """The zone lookup; ``partial`` leaves one region out, so that some trips find no zone."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    if partial:
        region = region.where(F.col("r_name") != LEFT_OUT_REGION)
    key, borough, zone, service = LOOKUP_COLUMNS.fieldNames()
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias(key),
        F.col("r_name").alias(borough),
        F.col("n_name").alias(zone),
        F.lit(None).cast("string").alias(service),
    )


def zones(spark: SparkSession, sf_dir: str, partial: bool = False) -> Lookup:
    return check_lookup(zone_frame(spark, sf_dir, partial))


def sql_trips(distance: str = "l_quantity") -> str:
    """CTE ``trips``: the columns the twins use, under short names."""
    return f"""trips AS (
  SELECT l_orderkey AS trip_key, l_linenumber AS line, o_orderdate AS pickup, l_shipdate AS dropoff,
         l_discount AS passengers, {distance} AS distance, l_returnflag AS flag,
         c_nationkey AS pu, s_nationkey AS dof, l_extendedprice AS fare
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)"""


def sql_zones(partial: bool = False) -> str:
    where = f"WHERE r_name <> '{LEFT_OUT_REGION}'" if partial else ""
    return f"""zones AS (
  SELECT n_nationkey AS id, r_name AS borough, n_name AS zone
  FROM nation JOIN region ON n_regionkey = r_regionkey {where})"""
