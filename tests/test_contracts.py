import pytest
from pyspark.sql import types as T

from tidemark.model import LANDING_CONTRACT, SILVER_CONTRACT, TRIP_COLUMNS
from tidemark.operators.contracts import (
    ContractError,
    added_columns,
    check_contract,
    check_types,
    conform,
    drift_report,
    local_times,
    missing_columns,
)
from trips import frame, raw_frame, raw_trip, trip


def test_contract_sizes():
    assert len(LANDING_CONTRACT) == 4 and len(SILVER_CONTRACT) == 22


def test_full_frames_pass(spark):
    check_contract(frame(spark, [trip(1)]), LANDING_CONTRACT, "landing")
    check_contract(raw_frame(spark, [raw_trip(1)]), SILVER_CONTRACT, "raw")


def test_missing_and_added(spark):
    schema = frame(spark, [trip(1)]).withColumnRenamed("extra", "Extra").schema
    assert missing_columns(schema, TRIP_COLUMNS) == ["extra"]
    assert added_columns(schema, TRIP_COLUMNS) == ["Extra"]


def test_drift_report(spark):
    df = frame(spark, [trip(1)]).selectExpr(
        "* EXCEPT (extra, VendorID)", "CAST(VendorID AS string) AS VendorID", "1 AS new_col")
    found = {tuple(r) for r in drift_report(df, TRIP_COLUMNS).collect()}
    assert found == {("extra", "missing", "double", None), ("new_col", "added", None, "int"),
                     ("VendorID", "type", "int", "string")}


def test_conform_only_widens(spark):
    df = frame(spark, [trip(1)]).selectExpr(
        "CAST(passenger_count AS int) AS passenger_count", "'1' AS VendorID", "1 AS other")
    out = conform(df, TRIP_COLUMNS)
    assert out.schema["passenger_count"].dataType == T.LongType()
    assert out.schema["VendorID"].dataType == T.StringType()
    assert out.columns == df.columns


def test_types_are_checked(spark):
    df = frame(spark, [trip(1)])
    check_types(df.drop("extra").selectExpr("*", "'x' AS other"), TRIP_COLUMNS, "landing")
    with pytest.raises(ContractError, match=r"landing: .*VendorID \(expected int, found string\)"):
        check_types(df.selectExpr("* EXCEPT (VendorID)", "'1' AS VendorID"), TRIP_COLUMNS, "landing")


def test_local_times(spark):
    name = "tpep_pickup_datetime"
    df = frame(spark, [trip(1)])
    zoned = df.withColumn(name, df[name].cast("timestamp"))
    out = local_times(zoned, TRIP_COLUMNS)
    assert out.columns == df.columns and out.schema[name].dataType == T.TimestampNTZType()
    assert out.first()[name] == df.first()[name]
    assert local_times(df, TRIP_COLUMNS).schema == df.schema
