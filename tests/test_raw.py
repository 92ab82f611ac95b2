"""Landing to raw, edge by edge."""

from collections import Counter
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import SILVER_CONTRACT, TRIP_COLUMNS, RunKey, struct_of
from tidemark.operators.contracts import ContractError
from tidemark.plans import raw as raw_plan
from tidemark.plans.raw import RULES, landing_rules, load_raw, split_landing
from tidemark.plans.report import LostRowsError
from tidemark.sinks.tables import read_quarantine
from tidemark.sources.facts import read_month_file, read_partition
from trips import KEY, at, frame, land, totals, trip, with_column

CASES = [
    # (total_amount, changes, copies, expected destinations)
    (1, {}, 1, ["raw"]),
    (2, {}, 3, ["raw", "dropped_duplicates", "dropped_duplicates"]),
    (3, {"VendorID": None}, 2, ["dropped_nulls", "dropped_duplicates"]),
    (4, {"fare_amount": float("nan")}, 1, ["dropped_nulls"]),
    (5, {"fare_amount": float("nan")}, 2, ["dropped_nulls", "dropped_duplicates"]),
    (6, {"PULocationID": 1}, 1, ["raw"]),
    (7, {"PULocationID": 266}, 1, ["raw"]),
    (8, {"PULocationID": 0}, 1, ["dropped_locations"]),
    (9, {"DOLocationID": 267}, 1, ["dropped_locations"]),
    (10, {"PULocationID": None}, 1, ["dropped_nulls"]),
    (11, {"tpep_pickup_datetime": at("2024-01-01 00:00:00")}, 1, ["raw"]),
    (12, {"tpep_pickup_datetime": at("2024-01-31 23:59:59.999999")}, 1, ["raw"]),
    (13, {"tpep_pickup_datetime": at("2023-12-31 23:59:59")}, 1, ["dropped_stray_timestamps"]),
    (14, {"tpep_pickup_datetime": at("2024-02-01 00:00:00")}, 1, ["dropped_stray_timestamps"]),
    (15, {"tpep_pickup_datetime": at("2023-01-10 08:00:00")}, 1, ["dropped_stray_timestamps"]),
    (16, {"PULocationID": 0, "tpep_pickup_datetime": at("2023-01-10 08:00:00")}, 1,
     ["dropped_locations"]),
    (17, {"PULocationID": 0}, 3,
     ["dropped_locations", "dropped_duplicates", "dropped_duplicates"]),
]


def landing_rows():
    return [trip(total, **changes) for total, changes, copies, _ in CASES for _ in range(copies)]


def expected():
    return Counter((float(total), place) for total, _, _, places in CASES for place in places)


def found(spark, layout):
    raw = read_partition(spark, layout.raw_facts, KEY).select("total_amount", F.lit("raw"))
    rejects = read_quarantine(spark, layout.quarantine, "raw").select("total_amount", "rule")
    return Counter(tuple(r) for r in raw.unionAll(rejects).collect())


def test_edge_rows_go_where_they_belong(spark, layout):
    land(frame(spark, landing_rows()), layout)
    report = load_raw(spark, layout, KEY)
    assert found(spark, layout) == expected()
    counts = Counter(place for place, n in
                     ((p, n) for (_, p), n in expected().items()) for _ in range(n))
    assert report.kept == counts.pop("raw")
    assert report.rejected == {rule: counts[rule] for rule in RULES}


def test_full_filter_gives_the_same_split(spark, layout, tmp_path):
    """With one block nearly every row becomes a candidate and is grouped exactly."""
    land(frame(spark, landing_rows()), layout)
    landing = read_month_file(spark, layout.landing_file(KEY), KEY)
    rules = landing_rules(landing, KEY)
    narrow = split_landing(landing, rules, str(tmp_path / "narrow"))
    wide = split_landing(landing, rules, str(tmp_path / "wide"), most_blocks=1)
    for a, b in ((narrow.kept, wide.kept), (narrow.rejects, wide.rejects),
                 (narrow.surplus, wide.surplus)):
        a, b = a.select(sorted(a.columns)), b.select(sorted(b.columns))
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
        assert a.count() == b.count()


def test_month_without_copies_or_rejects(spark, layout):
    land(frame(spark, [trip(i) for i in range(5)]), layout)
    report = load_raw(spark, layout, KEY)
    assert report.kept == 5 and set(report.rejected.values()) == {0}
    schema = struct_of(TRIP_COLUMNS)
    assert read_quarantine(spark, layout.quarantine, "raw", schema).isEmpty()


def test_column_outside_the_contract_counts_for_nulls(spark, layout):
    schema = with_column(TRIP_COLUMNS, "new_col", T.StringType())
    rows = [trip(1, new_col="a"), trip(2, new_col=None)]
    land(frame(spark, rows, schema), layout)
    load_raw(spark, layout, KEY)
    assert totals(read_partition(spark, layout.raw_facts, KEY)) == [1.0]
    assert totals(read_quarantine(spark, layout.quarantine, "raw")) == [2.0]


def test_null_check_on_a_subset(spark, layout):
    land(frame(spark, [trip(1, VendorID=None), trip(2, PULocationID=None)]), layout)
    load_raw(spark, layout, KEY, null_subset=["PULocationID"])
    assert totals(read_partition(spark, layout.raw_facts, KEY)) == [1.0]


def test_missing_column_writes_nothing(spark, layout):
    land(frame(spark, [trip(1)]).drop("DOLocationID"), layout)
    with pytest.raises(ContractError, match="DOLocationID"):
        load_raw(spark, layout, KEY)
    assert not Path(layout.raw_facts).exists() and not Path(layout.quarantine).exists()


def test_missing_month_is_named(spark, layout):
    with pytest.raises(FileNotFoundError, match="2024-01"):
        load_raw(spark, layout, KEY)
    assert not Path(layout.raw_facts).exists()


def test_lineage_survives_deduplication(spark, layout):
    land(frame(spark, landing_rows()), layout)
    load_raw(spark, layout, KEY)
    raw = read_partition(spark, layout.raw_facts, KEY)
    names = {r[0] for r in raw.select("source_file_name").distinct().collect()}
    assert names == {layout.landing_file(KEY).rsplit("/", 1)[1]}
    assert raw.select("ingestion_timestamp").distinct().count() == 1
    assert raw.columns == SILVER_CONTRACT.fieldNames()


def test_landed_audit_columns_are_replaced(spark, layout):
    df = frame(spark, [trip(1), trip(1)]).selectExpr("*", "'old' AS source_file_name")
    land(df, layout)
    report = load_raw(spark, layout, KEY)
    raw = read_partition(spark, layout.raw_facts, KEY)
    assert raw.columns == SILVER_CONTRACT.fieldNames()
    assert raw.first()["source_file_name"] == layout.landing_file(KEY).rsplit("/", 1)[1]
    assert report.rejected["dropped_duplicates"] == 1


HELPERS = [
    "_at", "_fp", "_i", "_word", "_bits", "_copies", "_file_id", "_block", "_size", "_side", "_source_file", "_reasons",
    "_AT", "a b", "x-y", "d.o.t", "tick`s", "aside", "Aside2",
]
DIRECTORIES = {"rule": "landed_rule", "Year": "landed_Year", "month": "landed_month", "layer": "landed_layer", "_version": "landed_version"}


@pytest.mark.parametrize("names", [HELPERS[:12], HELPERS[12:], list(DIRECTORIES)])
def test_landed_columns_keep_their_values_whatever_their_names(spark, layout, names):
    # One unique row, one with a copy, one reject: every branch of the load sees the columns.
    rows = [trip(1), trip(2), trip(2), trip(3, PULocationID=0)]
    landed = frame(spark, rows)
    for n, name in enumerate(names):
        landed = landed.withColumn(name, F.concat(F.lit(f"{n}:"), F.col("total_amount").cast("int")))
    land(landed, layout)
    report = load_raw(spark, layout, KEY)
    assert report.kept == 2 and report.rejected["dropped_duplicates"] == 1
    raw = read_partition(spark, layout.raw_facts, KEY)
    rejects = read_quarantine(spark, layout.quarantine, "raw")
    for n, name in enumerate(names):
        column = F.col(f"`{DIRECTORIES.get(name, name).replace('`', '``')}`")
        for side, totals_there in ((raw, [1, 2]), (rejects, [2, 3])):
            assert sorted(r[0] for r in side.select(column).collect()) == [f"{n}:{t}" for t in totals_there]


def test_null_rule_of_a_column_that_steps_aside(spark, layout):
    landed = frame(spark, [trip(1), trip(2)]).withColumn("_fp", F.when(F.col("total_amount") == 1, 5))
    land(landed, layout)
    assert load_raw(spark, layout, KEY, null_subset=["_fp"]).rejected["dropped_nulls"] == 1


def test_rerun_with_fixed_input_leaves_no_stale_rejects(spark, layout):
    land(frame(spark, landing_rows()), layout)
    load_raw(spark, layout, KEY)
    first = found(spark, layout)
    load_raw(spark, layout, KEY)
    assert found(spark, layout) == first
    land(frame(spark, [trip(1), trip(2, PULocationID=0)]), layout)
    load_raw(spark, layout, KEY)
    assert found(spark, layout) == Counter({(1.0, "raw"): 1, (2.0, "dropped_locations"): 1})


def test_other_months_stay(spark, layout):
    other = RunKey(2024, 2)
    february = trip(9, tpep_pickup_datetime=at("2024-02-03 00:00:00"))
    land(frame(spark, [trip(1)]), layout)
    land(frame(spark, [february]), layout, other)
    for key in (KEY, other, KEY):
        load_raw(spark, layout, key)
    assert totals(read_partition(spark, layout.raw_facts, other)) == [9.0]


def test_narrow_types_are_widened_to_the_contract(spark, layout):
    df = frame(spark, [trip(1)]).withColumns(
        {"passenger_count": F.col("passenger_count").cast("int"),
         "trip_distance": F.col("trip_distance").cast("float")})
    land(df, layout)
    load_raw(spark, layout, KEY)
    schema = read_partition(spark, layout.raw_facts, KEY).schema
    assert schema["passenger_count"].dataType == T.LongType()
    assert schema["trip_distance"].dataType == T.DoubleType()


@pytest.mark.parametrize("order", [(0, 1), (1, 0)])
def test_parts_with_different_columns(spark, layout, order):
    """No column is lost; rows of the part that lacks it are taken out as nulls, in any order."""
    schema = with_column(TRIP_COLUMNS, "new_col", T.StringType())
    parts = [frame(spark, [trip(1)]), frame(spark, [trip(2, new_col="a")], schema)]
    path = Path(layout.landing_file(KEY))
    path.mkdir(parents=True)
    for place, part in enumerate(order):
        pq.write_table(parts[part].toArrow(), path / f"part-{place}.parquet")
    report = load_raw(spark, layout, KEY)
    row = read_partition(spark, layout.raw_facts, KEY).first()
    assert (row["total_amount"], row["new_col"]) == (2.0, "a")
    assert (report.landed, report.kept, report.rejected["dropped_nulls"]) == (2, 1, 1)


@pytest.mark.parametrize("column, dtype", [("passenger_count", "double"), ("PULocationID", "bigint"),
                                           ("fare_amount", "string")])
def test_other_type_writes_nothing(spark, layout, column, dtype):
    land(frame(spark, [trip(1)]).withColumn(column, F.col(column).cast(dtype)), layout)
    with pytest.raises(ContractError, match=rf"{column} \(expected \w+, found {dtype}\)"):
        load_raw(spark, layout, KEY)
    assert not Path(layout.raw_facts).exists() and not Path(layout.quarantine).exists()


def test_lost_rows_are_an_error(spark, layout, monkeypatch):
    land(frame(spark, [trip(i) for i in range(4)]), layout)
    real = raw_plan.with_audit
    monkeypatch.setattr(raw_plan, "with_audit", lambda kept: real(kept.where("total_amount > 1")))
    with pytest.raises(LostRowsError, match="4 rows landed, 2 were written"):
        load_raw(spark, layout, KEY)


def test_file_of_a_copy_is_one_of_its_files(spark, layout):
    path = Path(layout.landing_file(KEY))
    path.mkdir(parents=True)
    for name in ("a b", "c"):
        pq.write_table(frame(spark, [trip(1), trip(2)]).toArrow(), path / f"{name}.parquet")
    for _ in range(2):
        load_raw(spark, layout, KEY)
        raw = read_partition(spark, layout.raw_facts, KEY)
        names = {r["source_file_name"] for r in raw.collect()}
        assert len(names) == 1 and names < {"a b.parquet", "a%20b.parquet", "c.parquet"}
        assert totals(raw) == [1.0, 2.0]


def test_zoned_timestamps_use_the_session_zone(spark, layout):
    """A TIMESTAMP pickup is compared in its own type, so the range still reaches the scan."""
    zoned = frame(spark, [trip(1), trip(2, tpep_pickup_datetime=at("2024-02-01 00:00:00"))])
    for name in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
        zoned = zoned.withColumn(name, F.col(name).cast("timestamp"))
    land(zoned, layout)
    load_raw(spark, layout, KEY)
    assert totals(read_partition(spark, layout.raw_facts, KEY)) == [1.0]
    schema = read_partition(spark, layout.raw_facts, KEY).schema
    assert schema["tpep_pickup_datetime"].dataType == T.TimestampNTZType()
