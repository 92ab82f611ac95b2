"""Raw to silver, edge by edge."""

from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import SILVER_CONTRACT
from tidemark.operators.contracts import ContractError
from tidemark.operators.lookups import DuplicateKeyError
from tidemark.plans import silver as silver_plan
from tidemark.plans.raw import Split
from tidemark.plans.report import LostRowsError
from tidemark.plans.silver import RULES, load_silver
from tidemark.sinks.tables import read_quarantine
from tidemark.sources.facts import read_partition
from trips import KEY, ZONES, at, frame, raw_frame, raw_trip, totals, with_column, write_lookup, write_raw


def times(pickup, dropoff):
    return {
        "tpep_pickup_datetime": at(f"2024-01-10 {pickup}"),
        "tpep_dropoff_datetime": at(f"2024-01-10 {dropoff}") if dropoff else None,
    }


INVERTED = times("08:00:00", "07:59:00")
CASES = [
    (1, {}, ["silver"]),
    (2, times("08:00:00", "08:00:00"), ["silver"]),
    (3, times("08:00:05.900000", "08:00:05.200000"), ["silver"]),
    (4, times("08:00:05.100000", "08:00:04.900000"), ["faulty_timestamps"]),
    (5, INVERTED, ["faulty_timestamps"]),
    (6, times("08:00:00", None), ["silver"]),
    (7, {"passenger_count": 0}, ["faulty_passenger_count"]),
    (8, {"passenger_count": None}, ["silver"]),
    (9, {"trip_distance": 0.0}, ["faulty_trip_distance"]),
    (10, {"trip_distance": -0.0}, ["faulty_trip_distance"]),
    (11, {"trip_distance": None}, ["silver"]),
    (12, {"trip_distance": -1.0}, ["silver"]),
    (13, INVERTED | {"passenger_count": 0}, ["faulty_timestamps"]),
    (14, {"PULocationID": 5}, ["faulty_pickup_locations"]),
    (15, {"PULocationID": 4}, ["faulty_pickup_locations"]),
    (16, {"PULocationID": None}, ["faulty_pickup_locations"]),
    (17, {"DOLocationID": 5}, ["faulty_dropoff_locations"]),
    (18, {"PULocationID": 5, "DOLocationID": 6},
     ["faulty_pickup_locations", "faulty_dropoff_locations"]),
    (19, {"passenger_count": 0, "PULocationID": 5}, ["faulty_passenger_count"]),
    (20, {"trip_distance": float("nan")}, ["silver"]),
    (21, {"passenger_count": -(2**63)}, ["silver"]),
]
EXPECTED = Counter((float(total), place) for total, _, places in CASES for place in places)


def found(spark, layout):
    silver = read_partition(spark, layout.silver_facts, KEY).select("total_amount", F.lit("silver"))
    rejects = read_quarantine(spark, layout.quarantine, "silver", SILVER_CONTRACT)
    return Counter(tuple(r) for r in
                   silver.unionAll(rejects.select("total_amount", "rule")).collect())


def case_rows():
    return [raw_trip(total, **changes) for total, changes, _ in CASES]


def test_edge_rows_go_where_they_belong(spark, layout):
    write_raw(raw_frame(spark, case_rows()), layout)
    write_lookup(spark, layout)
    report = load_silver(spark, layout, KEY)
    assert found(spark, layout) == EXPECTED
    assert report.kept == sum(n for (_, p), n in EXPECTED.items() if p == "silver")
    assert report.rejected == {
        rule: sum(n for (_, p), n in EXPECTED.items() if p == rule) for rule in RULES}


def test_lookup_too_large_to_broadcast_gives_the_same(spark, layout, monkeypatch):
    monkeypatch.setattr("tidemark.operators.lookups.BROADCAST_BYTES", 0)
    write_raw(raw_frame(spark, case_rows()), layout)
    write_lookup(spark, layout)
    load_silver(spark, layout, KEY)
    assert found(spark, layout) == EXPECTED


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_time_order_does_not_depend_on_the_session_zone(spark, layout, zone):
    """02:30 does not exist in New York on this day; as a zoned time it would move."""
    gap = {"tpep_pickup_datetime": at("2024-03-10 02:30:00"),
           "tpep_dropoff_datetime": at("2024-03-10 03:10:00")}
    write_raw(raw_frame(spark, [raw_trip(1, **gap)]), layout)
    write_lookup(spark, layout)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        load_silver(spark, layout, KEY)
        assert found(spark, layout) == Counter({(1.0, "silver"): 1})
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_file_of_negative_zeros_loses_no_row(spark, layout):
    write_raw(raw_frame(spark, [raw_trip(i, trip_distance=-0.0) for i in range(5)]), layout)
    write_lookup(spark, layout)
    load_silver(spark, layout, KEY)
    assert found(spark, layout) == Counter(
        {(float(i), "faulty_trip_distance"): 1 for i in range(5)})


def test_missing_contract_column(spark, layout):
    write_raw(raw_frame(spark, [raw_trip(1)]).drop("Airport_fee"), layout)
    write_lookup(spark, layout)
    with pytest.raises(ContractError, match="Airport_fee"):
        load_silver(spark, layout, KEY)
    assert not Path(layout.silver_facts).exists() and not Path(layout.quarantine).exists()


def test_column_differing_by_case_is_missing(spark, layout):
    df = raw_frame(spark, [raw_trip(1)]).withColumnRenamed("Airport_fee", "airport_fee")
    write_raw(df, layout)
    write_lookup(spark, layout)
    with pytest.raises(ContractError, match=r"Airport_fee \(found airport_fee\)"):
        load_silver(spark, layout, KEY)


def test_added_column_is_kept_and_reported(spark, layout):
    schema = with_column(SILVER_CONTRACT, "new_col", T.StringType())
    write_raw(frame(spark, [raw_trip(1, new_col="n")], schema), layout)
    write_lookup(spark, layout)
    report = load_silver(spark, layout, KEY)
    assert read_partition(spark, layout.silver_facts, KEY).first()["new_col"] == "n"
    assert ("new_col", "added", None, "string") in report.drift


def test_fact_column_named_like_a_lookup_column(spark, layout):
    schema = with_column(SILVER_CONTRACT, "Zone", T.StringType())
    write_raw(frame(spark, [raw_trip(1, Zone="own")], schema), layout)
    write_lookup(spark, layout)
    load_silver(spark, layout, KEY)
    assert read_partition(spark, layout.silver_facts, KEY).first()["Zone"] == "own"


def test_duplicate_lookup_key(spark, layout):
    write_raw(raw_frame(spark, [raw_trip(1)]), layout)
    write_lookup(spark, layout, [*ZONES, (1, "B9", "Z9", "s")])
    with pytest.raises(DuplicateKeyError, match="for example 1"):
        load_silver(spark, layout, KEY)


def test_missing_month_and_missing_lookup(spark, layout):
    with pytest.raises(FileNotFoundError, match="2024-01"):
        load_silver(spark, layout, KEY)
    write_raw(raw_frame(spark, [raw_trip(1)]), layout)
    with pytest.raises(FileNotFoundError, match="zone lookup"):
        load_silver(spark, layout, KEY)


def test_rerun_leaves_no_stale_rejects(spark, layout):
    write_lookup(spark, layout)
    write_raw(raw_frame(spark, case_rows()), layout)
    load_silver(spark, layout, KEY)
    write_raw(raw_frame(spark, [raw_trip(1)]), layout)
    load_silver(spark, layout, KEY)
    assert found(spark, layout) == Counter({(1.0, "silver"): 1})
    assert totals(read_quarantine(spark, layout.quarantine, "silver", SILVER_CONTRACT)) == []


def test_raw_columns_keep_their_values_whatever_their_names(spark, layout):
    names = ["_reasons", "_hit", "_pickup_known", "_dropoff_known", "_pickup_known_key", "_PU_key", "a b", "d.o.t", "tick`s", "rule"]
    rows = [raw_trip(1), raw_trip(2, passenger_count=0), raw_trip(3, PULocationID=99, DOLocationID=99)]
    raw = raw_frame(spark, rows)
    for n, name in enumerate(names):
        raw = raw.withColumn(name, F.concat(F.lit(f"{n}:"), F.col("total_amount").cast("int")))
    write_raw(raw, layout)
    write_lookup(spark, layout)
    assert load_silver(spark, layout, KEY).kept == 1
    silver = read_partition(spark, layout.silver_facts, KEY)
    rejects = read_quarantine(spark, layout.quarantine, "silver")
    for n, name in enumerate(names):
        column = F.col("`" + {"rule": "landed_rule"}.get(name, name).replace("`", "``") + "`")
        assert [r[0] for r in silver.select(column).collect()] == [f"{n}:1"]
        assert sorted(r[0] for r in rejects.select(column).collect()) == [f"{n}:2", f"{n}:3", f"{n}:3"]


def test_lost_rows_leave_silver_as_it_was(spark, layout, monkeypatch):
    write_lookup(spark, layout)
    write_raw(raw_frame(spark, [raw_trip(1), raw_trip(2, PULocationID=99, DOLocationID=99)]), layout)
    load_silver(spark, layout, KEY)
    split = silver_plan.split_raw

    def lossy(raw, lookup):
        whole = split(raw, lookup)
        return Split(whole.kept, whole.rejects.limit(1))

    monkeypatch.setattr(silver_plan, "split_raw", lossy)
    write_raw(raw_frame(spark, [raw_trip(5), raw_trip(6, PULocationID=99, DOLocationID=99)]), layout)
    with pytest.raises(LostRowsError):
        load_silver(spark, layout, KEY)
    assert totals(read_partition(spark, layout.silver_facts, KEY)) == [1.0]
    assert totals(read_quarantine(spark, layout.quarantine, "silver")) == [2.0, 2.0]
