"""Silver to gold."""

import shutil

import pytest
from pyspark.sql import types as T

from tidemark.model import (
    GOLD_FARE,
    GOLD_FULL,
    GOLD_MONTH,
    GOLD_PEAK,
    GOLD_ZONE,
    GOLD_ZONE_HOUR,
    SILVER_CONTRACT,
    RunKey,
)
from tidemark.operators import marts
from tidemark.operators.lookups import DuplicateKeyError, check_lookup, enrich
from tidemark.plans import gold as gold_plan
from tidemark.plans.gold import build_gold, changed_months, mart_frames
from tidemark.sources.facts import read_table
from trips import KEY, ZONES, at, frame, raw_frame, raw_trip, with_column, write_lookup, write_silver


def gold(spark, layout, name, *order):
    return [tuple(r) for r in read_table(spark, layout.gold_table(name)).orderBy(*order).collect()]


def build(spark, layout, rows, zones=ZONES):
    write_silver(raw_frame(spark, rows), layout)
    write_lookup(spark, layout, zones)
    return build_gold(spark, layout)


def pickup_at(hour, day=10):
    return {"tpep_pickup_datetime": at(f"2024-01-{day:02d} {hour:02d}:15:00")}


def test_mean_of_ratios_not_ratio_of_sums(spark, layout):
    build(spark, layout, [
        raw_trip(1, fare_amount=10.0, trip_distance=1.0),
        raw_trip(2, fare_amount=30.0, trip_distance=10.0),
        raw_trip(3, fare_amount=99.0, trip_distance=0.0),
        raw_trip(4, fare_amount=7.0, trip_distance=0.0, PULocationID=3),
    ])
    assert gold(spark, layout, GOLD_FARE, "PUBorough") == [("B1", 6.5), ("B2", None)]


def test_mean_over_several_zones_of_a_borough(spark, layout):
    build(spark, layout, [
        raw_trip(1, fare_amount=10.0, trip_distance=1.0),
        raw_trip(2, fare_amount=10.0, trip_distance=1.0),
        raw_trip(3, fare_amount=1.0, trip_distance=1.0, PULocationID=2),
    ])
    assert gold(spark, layout, GOLD_FARE, "PUBorough") == [("B1", 7.0)]


def test_unmatched_pickup_stays_in_the_null_group(spark, layout):
    build(spark, layout, [raw_trip(1), raw_trip(2, PULocationID=5), raw_trip(3, PULocationID=None)])
    assert gold(spark, layout, GOLD_ZONE, "PUZone") == [(None, 2), ("Z1", 1)]
    full = read_table(spark, layout.gold_table(GOLD_FULL))
    assert full.where("PUZone IS NULL AND PUBorough IS NULL AND PUservice_zone IS NULL").count() == 2


def test_full_table_columns_and_roles(spark, layout):
    build(spark, layout, [raw_trip(1, DOLocationID=1), raw_trip(2, DOLocationID=3)])
    full = read_table(spark, layout.gold_table(GOLD_FULL))
    assert full.columns == [
        *SILVER_CONTRACT.fieldNames(), "PUBorough", "PUZone", "PUservice_zone",
        "DOBorough", "DOZone", "DOservice_zone", "year", "month"]
    rows = {r["total_amount"]: r for r in full.collect()}
    assert rows[1.0]["PUZone"] == rows[1.0]["DOZone"] == "Z1"
    assert (rows[2.0]["DOBorough"], rows[2.0]["DOZone"]) == ("B2", "Z3")
    assert (rows[1.0]["year"], rows[1.0]["month"]) == (2024, 1)


def test_zones_of_one_name_are_one_group(spark, layout):
    zones = [(1, "B1", "Same", "s"), (2, "B1", "Same", "s")]
    build(spark, layout, [raw_trip(1), raw_trip(2, PULocationID=2), raw_trip(3, PULocationID=2)], zones)
    assert gold(spark, layout, GOLD_ZONE, "PUZone") == [("Same", 3)]
    assert gold(spark, layout, GOLD_ZONE_HOUR, "PUZone") == [("Same", 8, 3)]


def test_years_fold_into_calendar_months(spark, layout):
    later = raw_trip(2, tpep_pickup_datetime=at("2025-01-05 09:00:00"))
    write_silver(raw_frame(spark, [later]), layout, RunKey(2025, 1))
    build(spark, layout, [raw_trip(1)])
    assert gold(spark, layout, GOLD_MONTH, "pickup_month") == [(1, 2)]


def test_peak_hours_break_ties_by_hour(spark, layout):
    rows = [raw_trip(i, **pickup_at(hour)) for i, hour in enumerate([10, 9, 8, 7])]
    rows += [raw_trip(10 + i, PULocationID=2, **pickup_at(h)) for i, h in enumerate([5, 6, 6])]
    build(spark, layout, rows)
    assert gold(spark, layout, GOLD_PEAK, "PUZone", "row_num") == [
        ("Z1", 7, 1, 1), ("Z1", 8, 1, 2), ("Z1", 9, 1, 3), ("Z2", 6, 2, 1), ("Z2", 5, 1, 2)]


def test_added_column_of_a_later_month(spark, layout):
    schema = with_column(SILVER_CONTRACT, "new_col", T.StringType())
    later = raw_trip(2, new_col="n", tpep_pickup_datetime=at("2024-02-05 09:00:00"))
    write_silver(frame(spark, [later], schema), layout, RunKey(2024, 2))
    build(spark, layout, [raw_trip(1)])
    full = read_table(spark, layout.gold_table(GOLD_FULL))
    found = {r["total_amount"]: r["new_col"] for r in full.collect()}
    assert found == {1.0: None, 2.0: "n"}


def test_refresh_replaces_everything(spark, layout):
    build(spark, layout, [raw_trip(1), raw_trip(2)])
    names = build(spark, layout, [raw_trip(3)])
    assert gold(spark, layout, GOLD_ZONE, "PUZone") == [("Z1", 1)]
    assert read_table(spark, layout.gold_table(GOLD_FULL)).count() == 1
    assert names == [GOLD_FULL, GOLD_FARE, GOLD_ZONE, GOLD_ZONE_HOUR, GOLD_MONTH, GOLD_PEAK]


def test_only_stale_months_are_refreshed(spark, layout, monkeypatch):
    refreshed = []
    real = gold_plan.refresh_month

    def counting(spark, layout, key, lookup):
        refreshed.append(key)
        real(spark, layout, key, lookup)

    monkeypatch.setattr(gold_plan, "refresh_month", counting)
    first, second = KEY, RunKey(2024, 2)
    february = {"tpep_pickup_datetime": at("2024-02-05 09:00:00")}
    build(spark, layout, [raw_trip(1), raw_trip(2)])
    assert refreshed == [] and changed_months(spark, layout) == ([], [])
    write_silver(raw_frame(spark, [raw_trip(3, **february)]), layout, second)
    build_gold(spark, layout)
    assert refreshed == [second]
    assert gold(spark, layout, GOLD_MONTH, "pickup_month") == [(1, 2), (2, 1)]
    write_silver(raw_frame(spark, [raw_trip(4)]), layout, first)
    build_gold(spark, layout)
    assert refreshed == [second, first]
    def rows(name):
        return sorted(gold(spark, layout, name, "PUZone"), key=str)

    incremental = {n: rows(n) for n in (GOLD_FULL, GOLD_ZONE, GOLD_PEAK)}
    build_gold(spark, layout, everything=True)
    assert incremental == {n: rows(n) for n in incremental}
    assert gold(spark, layout, GOLD_ZONE, "PUZone") == [("Z1", 2)]


def test_new_lookup_refreshes_every_month(spark, layout):
    build(spark, layout, [raw_trip(1)])
    write_lookup(spark, layout, [(1, "B1", "Renamed", "s")])
    assert changed_months(spark, layout) is None
    build_gold(spark, layout)
    assert read_table(spark, layout.gold_table(GOLD_FULL)).first()["PUZone"] == "Renamed"


def test_month_removed_from_silver_leaves_gold(spark, layout, monkeypatch):
    write_silver(raw_frame(spark, [raw_trip(9)]), layout, RunKey(2023, 1))
    build(spark, layout, [raw_trip(1)])
    assert gold(spark, layout, GOLD_ZONE, "PUZone") == [("Z1", 2)]
    shutil.rmtree(f"{layout.silver_facts}/year=2023")
    assert changed_months(spark, layout) == ([], [RunKey(2023, 1)])
    for refresh in ("refresh_month", "refresh_everything"):
        monkeypatch.setattr(gold_plan, refresh, lambda *_: pytest.fail("nothing is to refresh"))
    build_gold(spark, layout)
    assert gold(spark, layout, GOLD_ZONE, "PUZone") == [("Z1", 1)]
    assert read_table(spark, layout.gold_table(GOLD_FULL)).count() == 1


def test_large_aggregates_are_written_by_several_tasks(spark, layout):
    """A lookup with very many zones: no aggregate is forced into one task."""
    zones = 200_000
    lookup = spark.range(zones).selectExpr(
        "CAST(id AS int) AS LocationID", "'b' AS Borough", "concat('zone ', id) AS Zone",
        "CAST(NULL AS string) AS service_zone")
    lookup.write.option("header", True).csv(layout.lookup)
    facts = raw_frame(spark, [raw_trip(1)]).drop("PULocationID").crossJoin(
        spark.range(zones).selectExpr("CAST(id AS int) AS PULocationID"))
    write_silver(facts, layout)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        build_gold(spark, layout)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    table = read_table(spark, layout.gold_table(GOLD_ZONE_HOUR))
    assert table.count() == zones and len(table.inputFiles()) > 1


def test_duplicate_lookup_key(spark, layout):
    with pytest.raises(DuplicateKeyError):
        build(spark, layout, [raw_trip(1)], [*ZONES, (1, "B1", "Z1", "s")])


def test_repeated_null_keys_are_no_duplicates(spark, layout):
    build(spark, layout, [raw_trip(1)], [*ZONES, (None, "B", "Z", "s"), (None, "B", "Z", "s")])
    assert gold(spark, layout, GOLD_ZONE, "PUZone") == [("Z1", 1)]


def test_fact_columns_are_never_hidden(spark, layout):
    write_lookup(spark, layout)
    lookup = check_lookup(spark.createDataFrame(ZONES, "LocationID int, Borough string, "
                                                "Zone string, service_zone string"))
    df = raw_frame(spark, [raw_trip(1)]).selectExpr("*", "'own' AS LocationID", "'z' AS Zone")
    row = enrich(df, lookup).first()
    assert (row["LocationID"], row["Zone"], row["PUZone"]) == ("own", "z", "Z1")
    with pytest.raises(ValueError, match="PUZone"):
        enrich(df.selectExpr("*", "'x' AS PUZone"), lookup)


def test_missing_silver(spark, layout):
    with pytest.raises(FileNotFoundError):
        build_gold(spark, layout)


def test_the_marts_are_one_aggregation(spark):
    cube = spark.createDataFrame(
        [("B", "z", 1, 1, 2, 3.0, 2), (None, None, 1, 1, 5, 1.0, 1), ("B", "y", 1, 2, 7, None, 0), (None, "z", 2, 1, 1, 1.0, 1)],
        "PUBorough string, PUZone string, pickup_hour int, pickup_month int, trips bigint, ratio_sum double, ratio_count bigint",
    )
    text = marts.rollups(cube)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Expand") == 1
    frames = mart_frames(marts.rollups(cube))
    apart = {
        "avg_fare_per_mile": marts.avg_fare_per_mile(cube),
        "total_trips_count_per_zone": marts.trips_per_zone(cube),
        "trips_per_zone_per_hour": marts.trips_per_zone_hour(cube),
        "trips_per_month": marts.trips_per_month(cube),
        "zone_wise_peak_hours": marts.peak_hours(marts.trips_per_zone_hour(cube)),
    }
    assert frames.keys() == apart.keys()
    for name, frame in frames.items():
        assert frame.columns == apart[name].columns
        assert frame.exceptAll(apart[name]).isEmpty() and apart[name].exceptAll(frame).isEmpty()
