"""Builders for trip rows, lookups and landed files."""

from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.model import (
    LOOKUP_COLUMNS,
    SILVER_CONTRACT,
    TRIP_COLUMNS,
    Layout,
    RunKey,
    struct_of,
)

KEY = RunKey(2024, 1)
ZONES = [(1, "B1", "Z1", "s"), (2, "B1", "Z2", "s"), (3, "B2", "Z3", "s"), (4, "B2", None, "s")]
_VALUES = {
    T.IntegerType: 1,
    T.LongType: 1,
    T.DoubleType: 1.0,
    T.StringType: "x",
    T.TimestampType: datetime(2024, 2, 1),
}


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def trip(total: float, schema: T.StructType = TRIP_COLUMNS, **changes) -> dict:
    row = {f.name: _VALUES.get(type(f.dataType)) for f in schema.fields}
    row |= {
        "tpep_pickup_datetime": at("2024-01-10 08:00:00"),
        "tpep_dropoff_datetime": at("2024-01-10 08:20:00"),
        "trip_distance": 2.0,
        "fare_amount": 10.0,
        "PULocationID": 1,
        "DOLocationID": 2,
        "total_amount": float(total),
    }
    return row | changes


def frame(spark: SparkSession, rows: list[dict], schema: T.StructType = TRIP_COLUMNS) -> DataFrame:
    return spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in rows], schema)


def raw_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return frame(spark, rows, SILVER_CONTRACT)


def raw_trip(total: float, **changes) -> dict:
    return trip(total, SILVER_CONTRACT, **changes)


def with_column(schema: T.StructType, name: str, dtype: T.DataType) -> T.StructType:
    return struct_of(schema, T.StructType([T.StructField(name, dtype)]))


def land(df: DataFrame, layout: Layout, key: RunKey = KEY) -> None:
    """One real Parquet file, as files arrive."""
    path = Path(layout.landing_file(key))
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(df.toArrow(), path)


def write_raw(df: DataFrame, layout: Layout, key: RunKey = KEY) -> None:
    df.write.mode("overwrite").parquet(f"{layout.raw_facts}/{key.partition}")


def write_silver(df: DataFrame, layout: Layout, key: RunKey = KEY) -> None:
    df.write.mode("overwrite").parquet(f"{layout.silver_facts}/{key.partition}")


def write_lookup(spark: SparkSession, layout: Layout, rows: list[tuple] = ZONES) -> None:
    df = spark.createDataFrame(rows, LOOKUP_COLUMNS)
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(layout.lookup)


def totals(df: DataFrame) -> list[float]:
    return sorted(r["total_amount"] for r in df.select("total_amount").collect())
