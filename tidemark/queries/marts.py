"""The aggregate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.model import OUT_HOUR_TRIPS, OUT_ZONE, PICKUP_LOCATION, PICKUP_TIME
from tidemark.operators import marts
from tidemark.queries.registry import query
from tidemark.queries.views import order_lines, select_trips, sql_zones, table, zones

_FARES = """
fares AS (SELECT c_nationkey AS pu, l_extendedprice / nullif({distance}, 0) AS per_mile
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey
          JOIN customer ON o_custkey = c_custkey)
SELECT borough AS pu_borough, round(avg(per_mile), 4) AS avg_fare_per_mile
FROM fares LEFT JOIN zones ON pu = id GROUP BY 1"""


def _fare_mart(spark: SparkSession, sf_dir: str, distance: str, partial: bool) -> DataFrame:
    """Grouped by location id before the zones are joined to the few resulting rows."""
    facts = select_trips(order_lines(spark, sf_dir, pickup=True), distance)
    cube = marts.trip_cube(facts, [F.col(PICKUP_LOCATION)])
    mart = marts.avg_fare_per_mile(marts.name_cube(cube, zones(spark, sf_dir, partial)))
    return mart.select(
        F.col("PUBorough").alias("pu_borough"),
        F.round("avg_fare_per_mile", 4).alias("avg_fare_per_mile"),
    )


@query("avg_fare_per_mile", f"WITH {sql_zones()}, {_FARES.format(distance='l_quantity')}")
def avg_fare_per_mile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fare_mart(spark, sf_dir, "l_quantity", partial=False)


@query("avg_fare_zero_distance", f"WITH {sql_zones(True)}, {_FARES.format(distance='l_tax')}")
def avg_fare_zero_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero distances give NULL ratios, and trips without a zone form the NULL group."""
    return _fare_mart(spark, sf_dir, "l_tax", partial=True)


@query("trips_per_zone", f"""
WITH {sql_zones()}
SELECT zone AS pu_zone, count(*) AS trips
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
LEFT JOIN zones ON c_nationkey = id GROUP BY 1""")
def trips_per_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = select_trips(order_lines(spark, sf_dir, pickup=True))
    cube = marts.trip_cube(facts, [F.col(PICKUP_LOCATION)])
    mart = marts.trips_per_zone(marts.name_cube(cube, zones(spark, sf_dir)))
    return mart.select(
        F.col("PUZone").alias("pu_zone"), F.col("total_trip_count_per_zone").alias("trips")
    )


def event_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips per zone and hour. Events stand in for trips where hours matter; the event type is the
    zone."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias(OUT_ZONE), F.col("ts").alias(PICKUP_TIME),
        F.col("value").alias("fare_amount"), F.lit(1.0).alias("trip_distance"),
    )
    _, hour, month = marts.cube_keys()
    return marts.trips_per_zone_hour(marts.trip_cube(events, [F.col(OUT_ZONE), hour, month]))


_ZONE_HOURS = """
SELECT event_type AS pu_zone, CAST(hour(ts) AS INTEGER) AS pickup_hour, count(*) AS trips
FROM events GROUP BY 1, 2"""


@query("trips_per_zone_hour", _ZONE_HOURS)
def trips_per_zone_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_hours(spark, sf_dir).withColumnsRenamed(
        {OUT_ZONE: "pu_zone", OUT_HOUR_TRIPS: "trips"}
    )


@query("trips_per_month", """
SELECT CAST(month(o_orderdate) AS INTEGER) AS pickup_month, count(*) AS trips_per_month
FROM orders GROUP BY 1""")
def trips_per_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = (
        table(spark, sf_dir, "orders").groupBy(F.month("o_orderdate").alias("pickup_month"))
        .agg(F.count(F.lit(1)).alias("trips"))
    )
    return marts.trips_per_month(months)


@query("peak_hours", f"""
WITH hours AS ({_ZONE_HOURS}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY pu_zone ORDER BY trips DESC, pickup_hour)
           AS row_num FROM hours)
SELECT pu_zone, pickup_hour, trips, CAST(row_num AS INTEGER) AS row_num
FROM ranked WHERE row_num < 4""")
def peak_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.peak_hours(event_hours(spark, sf_dir)).select(
        F.col("PUZone").alias("pu_zone"), "pickup_hour",
        F.col("trip_per_zone_per_hour").alias("trips"), "row_num",
    )
