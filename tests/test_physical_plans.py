"""The plans that matter at scale: what is pushed down, broadcast, shuffled and read once."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.model import LOOKUP_COLUMNS
from tidemark.operators import copies, lookups, marts, rules
from tidemark.plans.raw import landing_rules, split_landing
from tidemark.plans.silver import split_raw
from tidemark.queries import QUERIES
from tidemark.queries.views import MONTH, table, trips
from tidemark.sources.facts import SOURCE_FILE, read_month_file, read_partition, with_source
from tidemark.sources.lookup import reduce_lookup
from trips import KEY, ZONES, raw_frame, raw_trip, write_raw


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def pushed(text: str) -> str:
    return " ".join(re.findall(r"PushedFilters: \[[^]]*\]", text))


@pytest.fixture
def raw(spark, layout):
    write_raw(raw_frame(spark, [raw_trip(i) for i in range(4)]), layout)
    return read_partition(spark, layout.raw_facts, KEY)


@pytest.fixture
def landing(spark, layout):
    path = layout.landing_file(MONTH)
    trips(spark, "/root/testdata/sf0.001").write.parquet(path)
    return read_month_file(spark, path, MONTH)


@pytest.fixture
def lookup(spark):
    return lookups.check_lookup(spark.createDataFrame(ZONES, LOOKUP_COLUMNS))


@pytest.fixture(autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_period_reaches_the_scan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    text = plan(rules.keep_rows(orders, [rules.month_rule("r", "o_orderdate", MONTH)]))
    assert "GreaterThanOrEqual(o_orderdate,1996-03-01" in text
    assert "LessThan(o_orderdate,1996-04-01" in text


def test_silver_is_narrow(raw, lookup):
    split = split_raw(raw, lookup)
    for side in (split.kept, split.rejects):
        text = plan(side)
        assert "Exchange hashpartitioning" not in text.split("BroadcastExchange")[0]
        assert text.count("BroadcastHashJoin") == 2
        assert text.count("FileScan parquet [VendorID") == 1
        assert "SortMergeJoin" not in text


def test_zero_tests_are_not_pushed(raw, lookup):
    text = pushed(plan(split_raw(raw, lookup).rejects))
    assert "trip_distance" not in text and "passenger_count" not in text


def test_landing_rules_reach_the_scan(landing, tmp_path):
    split = split_landing(landing, landing_rules(landing, MONTH, (1, 24)), str(tmp_path / "s"))
    text = pushed(plan(split.kept))
    for part in ("IsNotNull(store_and_fwd_flag)", "GreaterThanOrEqual(PULocationID,1)",
                 "LessThanOrEqual(DOLocationID,24)", "LessThan(tpep_pickup_datetime,1996-04-01"):
        assert part in text, part


def test_kept_rows_are_asked_for_their_month_before_every_column_for_nulls(landing, tmp_path):
    split = split_landing(landing, landing_rules(landing, MONTH, (1, 24)), str(tmp_path / "s"))
    asked = re.search(r"Filter (.*)", plan(split.kept)).group(1)
    places = [re.search(test, asked).start() for test in
              (r"tpep_pickup_datetime#\d+ >=", r"PULocationID#\d+L? >=", r"isnan\(")]
    assert places == sorted(places)


def test_unique_rows_never_shuffle(landing, tmp_path):
    split = split_landing(landing, landing_rules(landing, MONTH), str(tmp_path / "s"))
    for side in (split.kept, split.rejects):
        assert "hashpartitioning" not in plan(side) and "FileScan" in plan(side)
    assert split.surplus is None


def test_repeated_rows_do_not_make_unique_ones_shuffle(spark, landing, tmp_path):
    path = str(tmp_path / "twice")
    landing.unionAll(landing.where("VendorID = 1")).write.parquet(path)
    twice = read_month_file(spark, path, MONTH)
    split = split_landing(twice, landing_rules(twice, MONTH), str(tmp_path / "s"))
    for side in (split.kept, split.rejects):
        text = plan(side)
        assert "hashpartitioning" not in text
        assert re.search(r"BroadcastHashJoin .*LeftOuter", text)
        assert "row_index" not in text


def test_only_candidates_shuffle_however_many_rows_repeat(spark, landing, tmp_path):
    """Every row repeats, and the filter has a single block: the plan is the same, and the whole rows
    are shuffled once."""
    path = str(tmp_path / "all")
    landing.unionAll(landing).write.parquet(path)
    twice = read_month_file(spark, path, MONTH)
    split = split_landing(twice, landing_rules(twice, MONTH), str(tmp_path / "s"), most_blocks=1)
    for side in (split.kept, split.rejects):
        assert "hashpartitioning" not in plan(side)
    columns = twice.columns
    marks = copies.mark_repeats(copies.repeated_fingerprints(twice, columns), 64)
    _, candidates = copies.split_marked(twice.withColumn("_f", F.lit(1)), columns, marks, 64)
    text = plan(copies.count_copies(candidates, "_f"))
    whole = [e for e in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text) if "VendorID" in e]
    assert len(whole) == 1


def test_filter_is_bounded_and_grows_with_what_repeats(spark):
    prints = spark.range(20_000).select(F.xxhash64("id").alias("_fp"))
    assert copies.mark_repeats(prints, 64).count() == 64
    assert copies.filter_blocks(0) == 1 and copies.filter_blocks(10**12) == copies.BLOCKS
    for repeats in (1_000, 10_000_000, 40_000_000):
        bits = copies.filter_blocks(repeats) * 64 * copies.LANES
        assert copies.BITS_EACH * repeats <= bits <= max(2 * copies.BITS_EACH * repeats, 512)


def test_below_one_percent_of_unique_rows_are_candidates(spark):
    """The filter's load is the same at ten million repeats: blocks grow with them."""
    repeats, unique = 170_000, 500_000  # just below a power of two of blocks, the fullest it gets
    data = spark.range(repeats + unique).withColumn("n", F.when(F.col("id") < repeats, 2).otherwise(1))
    rows = data.select("id", F.explode(F.sequence(F.lit(1), "n")).alias("copy")).select("id")
    blocks = copies.filter_blocks(repeats)
    assert repeats * copies.BITS_EACH > 0.9 * blocks * 64 * copies.LANES
    marks = copies.mark_repeats(copies.repeated_fingerprints(rows, ["id"]), blocks)
    certain, candidates = copies.split_marked(rows, ["id"], marks, blocks)
    assert candidates.where(F.col("id") < repeats).count() == 2 * repeats
    assert candidates.where(F.col("id") >= repeats).count() < 0.01 * unique
    assert certain.count() + candidates.count() == 2 * repeats + unique


def test_file_metadata_is_read_only_for_the_name(landing, tmp_path):
    split = split_landing(landing, landing_rules(landing, MONTH), str(tmp_path / "s"))
    assert "file_name" in plan(split.kept) and "file_size" not in plan(split.kept)
    assert "file_name" not in plan(split.rejects)
    assert "file_name" not in plan(copies.repeated_fingerprints(landing, landing.columns))


def test_copies_shuffle_fingerprints_only(landing):
    text = plan(copies.repeated_fingerprints(landing, landing.columns))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert len(exchanges) == 1 and exchanges[0].startswith("_fp")
    assert text.count("HashAggregate") == 2


def test_copies_are_counted_by_hash(landing):
    """Under a sort-based partial aggregate every copy of a hot row would be sorted."""
    named = with_source(landing).withColumn(SOURCE_FILE, F.xxhash64(SOURCE_FILE))
    text = plan(copies.count_copies(named, SOURCE_FILE))
    lowest = text[text.rindex("Aggregate(") - 4:]
    assert lowest.startswith("HashAggregate(")


def test_surplus_copies_scan_once(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity")
    df = copies.surplus_copies(lines)
    df.collect()
    text = plan(df)
    assert "isFinalPlan=true" in text and "ReusedExchange" in text.split("== Initial Plan ==")[0]


def test_set_difference_has_no_join(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity")
    text = plan(copies.set_difference(lines, lines.where("l_quantity <= 25")))
    assert "Join" not in text and text.count("Exchange hashpartitioning") == 1


def test_marts_aggregate_before_the_lookup(raw, lookup):
    text = plan(marts.name_cube(marts.trip_cube(raw), lookup))
    join, below = text.split("BroadcastHashJoin", 1)
    assert "HashAggregate" in below and "HashAggregate" not in join
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert len(read.split(",")) <= 4


def test_peak_hours_limit_each_group_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["peak_hours"](spark, sf_dir))
    assert text.count("WindowGroupLimit") == 2


def test_enrichment_is_narrow(raw, lookup):
    text = plan(lookups.enrich(raw, lookup))
    assert text.count("BroadcastHashJoin") == 2
    assert "Exchange hashpartitioning" not in text.split("BroadcastExchange")[0]


def test_large_lookup_is_not_broadcast_by_hint(raw, lookup):
    assert lookup.bytes <= lookups.BROADCAST_BYTES
    side = lookup.side(lookup.frame, limit=0)
    joined = raw.join(side.select(F.col("LocationID").alias("k")), F.col("PULocationID") == F.col("k"))
    assert "strategy=broadcast" not in joined._jdf.queryExecution().analyzed().toString()


def test_scans_read_only_what_is_used(spark, sf_dir):
    text = plan(QUERIES["zero_reject"](spark, sf_dir))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_discount:double,l_tax:double>" in text


def test_a_large_lookup_is_reduced_to_the_keys_in_use(raw, lookup, monkeypatch):
    """Above the limit only distinct keys are shuffled: the facts stay where they are, with the same rows."""
    expected = lookups.enrich(raw, lookup)
    assert reduce_lookup(lookup, raw, ["PULocationID"]) is lookup
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", 0)
    assert "SortMergeJoin" in plan(lookups.enrich(raw, lookup))
    reduced = reduce_lookup(lookup, raw, ["PULocationID", "DOLocationID"])
    assert reduced.reduced and 0 < reduced.rows <= lookup.rows
    found = lookups.enrich(raw, reduced)
    assert "Exchange hashpartitioning" not in plan(found)
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
    flagged = lookups.flag_known(raw, "PULocationID", reduced, "known")
    assert flagged.where("known").count() == lookups.matched(raw, "PULocationID", lookup).count()
