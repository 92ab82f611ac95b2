"""Raw to silver: one month, held to the contract, the business rules and the zone lookup."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.model import (
    DROPOFF_LOCATION,
    DROPOFF_TIME,
    PICKUP_LOCATION,
    PICKUP_TIME,
    ROLES,
    RULE_DISTANCE,
    RULE_DROPOFF,
    RULE_PASSENGERS,
    RULE_PICKUP,
    RULE_TIMES,
    SILVER_CONTRACT,
    Layout,
    RunKey,
)
from tidemark.operators.contracts import (
    check_contract,
    check_types,
    conform,
    drift_rows,
    local_times,
)
from tidemark.operators.lookups import Lookup, flag_known
from tidemark.operators.names import keep_clear_of_directories, step_aside
from tidemark.operators.reconcile import reconcile
from tidemark.operators.rules import (
    REASONS,
    Rule,
    classify,
    keep_rows,
    order_rule,
    rejected,
    unknown_rule,
    zero_rule,
)
from tidemark.plans.raw import Split
from tidemark.plans.report import LoadReport, report_load
from tidemark.sinks.tables import (
    count_rows,
    discard_quarantine,
    link_quarantine,
    many_rejects,
    read_month_rejects,
    replace_quarantine,
    tidy_quarantine,
    write_version,
)
from tidemark.sources.facts import read_partition
from tidemark.sources.lookup import read_lookup, reduce_lookup
from tidemark.sources.scratch import remove_scratch, scratch_path, settle
from tidemark.sources.versions import (
    current_month,
    discard_version,
    new_version,
    switch_month,
    tidy_month,
    version_path,
)

LAYER = "silver"
RULES = (RULE_TIMES, RULE_PASSENGERS, RULE_DISTANCE, RULE_PICKUP, RULE_DROPOFF)
_FLAGS = ("_pickup_known", "_dropoff_known")
# Columns of silver rejects: the raw file a row came from, and its position there.
POSITION = ("raw_file", "raw_row")


def business_rules() -> list[Rule]:
    """Time order, passengers and distance; a row goes to the first rule it fails."""
    return [
        order_rule(RULE_TIMES, PICKUP_TIME, DROPOFF_TIME),
        zero_rule(RULE_PASSENGERS, "passenger_count"),
        zero_rule(RULE_DISTANCE, "trip_distance"),
    ]


def location_rules() -> list[Rule]:
    """Both locations must be known; a row failing both is quarantined under both."""
    return [unknown_rule(RULE_PICKUP, _FLAGS[0]), unknown_rule(RULE_DROPOFF, _FLAGS[1])]


def with_known_flags(facts: DataFrame, lookup: Lookup) -> DataFrame:
    flagged = flag_known(facts, PICKUP_LOCATION, lookup, _FLAGS[0])
    return flag_known(flagged, DROPOFF_LOCATION, lookup, _FLAGS[1])


def with_position(raw: DataFrame) -> DataFrame:
    """A scan with the file and the position in it of each row, which tell rows apart for good."""
    file, row = POSITION
    return raw.select(
        "*", F.col("_metadata.file_name").alias(file), F.col("_metadata.row_index").alias(row)
    )


def split_raw(raw: DataFrame, lookup: Lookup) -> Split:
    """Narrow on the facts: the rules are expressions and the lookup is broadcast.

    Relies on raw rows being distinct, as the raw load leaves them. ``raw`` must come from a file scan:
    rejects also have their position in raw.
    """
    sequential, parallel = business_rules(), location_rules()
    flagged = with_known_flags(raw, lookup)
    placed = with_known_flags(with_position(raw), lookup)
    return Split(
        keep_rows(flagged, sequential + parallel).drop(*_FLAGS),
        rejected(classify(placed, sequential, parallel)).drop(*_FLAGS),
    )


def _to_place(raw: DataFrame, lookup: Lookup) -> tuple[int, int]:
    """Rows of ``raw``, and those that both location rules reject. Reads the rules' columns only."""
    classified = classify(with_known_flags(raw, lookup), business_rules(), location_rules())
    return tuple(classified.agg(F.count(F.lit(1)), F.count_if(F.size(REASONS) > 1)).first())


def load_silver(spark: SparkSession, layout: Layout, key: RunKey) -> LoadReport:
    """Load one raw month into silver and quarantine what fails. Replaces the month in one step.

    Columns beyond the contract are kept, whatever their names, and reported as drift. As in the raw
    load, facts and rejects become current together, and only if every raw row was placed: once, or
    under both location rules.
    """
    raw = read_partition(spark, layout.raw_facts, key)
    path = f"{layout.raw_facts}/{key.partition}"
    check_contract(raw, SILVER_CONTRACT, path)
    drift = drift_rows(raw.schema, SILVER_CONTRACT)
    raw = local_times(conform(raw, SILVER_CONTRACT), SILVER_CONTRACT)
    check_types(raw, SILVER_CONTRACT, path)
    raw, names = step_aside(keep_clear_of_directories(raw, POSITION))
    lookup = reduce_lookup(read_lookup(spark, layout.lookup), raw, ROLES)
    split = split_raw(raw, lookup)
    written = Split(names.back(split.kept), names.back(split.rejects))
    return _write_month(spark, layout, key, written, lambda: _to_place(raw, lookup), drift)


def _write_month(
    spark: SparkSession, layout: Layout, key: RunKey, split: Split,
    to_place: Callable[[], tuple[int, int]], drift: Iterable[tuple] = (),
) -> LoadReport:
    """Write both sides as a new version and switch to it once ``to_place`` agrees with the rows written:
    it gives the rows to place, and how many of them two rules reject."""
    version = new_version()
    path = f"{layout.silver_facts}/{key.partition}"
    try:
        write_version(split.kept, layout.silver_facts, key, version)
        landed, twice = to_place()
        rejects = landed + twice - count_rows(spark, version_path(layout.silver_facts, key, version))
        replace_quarantine(
            split.rejects, layout.quarantine, LAYER, key, version, many_rejects(rejects, landed + twice)
        )
        report = report_load(
            spark, layout.silver_facts, layout.quarantine, LAYER, key, RULES, version, drift, landed
        )
        report.check_conserved(path, twice)
        link_quarantine(spark, layout.quarantine, LAYER, layout.silver_facts)
        switch_month(spark, layout.silver_facts, key, version, split.kept.schema)
    except Exception:
        discard_version(spark, layout.silver_facts, key, version)
        discard_quarantine(spark, layout.quarantine, LAYER, key, version)
        raise
    tidy_month(spark, layout.silver_facts, key)
    tidy_quarantine(spark, layout.quarantine, LAYER, key)
    return report


class ReplayError(ValueError):
    """Rejects alone do not tell the month's state; it has to be loaded from raw."""


def replay_rejects(spark: SparkSession, layout: Layout, key: RunKey) -> LoadReport:
    """Judge the rows of a silver month again that a location rule rejected, after the lookup has grown.

    Rows that are known now move to silver; the others stay in quarantine under the rules they still
    fail. Nothing of raw is read, and rows that were kept or failed another rule are copied as they
    are: for a lookup that has lost nothing, the result is that of loading the month again. A row
    that both rules rejected is found twice and known by its position in raw. Raises ``ReplayError``
    if a kept row's location is unknown now, or raw is newer than silver.
    """
    path = f"{layout.silver_facts}/{key.partition}"
    silver = read_partition(spark, layout.silver_facts, key)
    raw, now = (current_month(spark, root, key) for root in (layout.raw_facts, layout.silver_facts))
    if now is None or now.version is None or (raw is not None and (raw.version or "") > now.version):
        raise ReplayError(f"{path}: raw has changed since")
    lookup = read_lookup(spark, layout.lookup)
    unknown = reduce(Column.__or__, [rule.rejects() for rule in location_rules()])
    if not with_known_flags(silver, lookup).where(unknown).limit(1).isEmpty():
        raise ReplayError(f"{path}: the lookup has lost a location")
    rejects = read_month_rejects(spark, layout.quarantine, LAYER, key)
    if rejects is None:
        return report_load(spark, layout.silver_facts, layout.quarantine, LAYER, key, RULES, now.version)

    by_location = F.col("rule").isin(RULE_PICKUP, RULE_DROPOFF)
    others = rejects.where(~by_location)
    once = rejects.where(by_location).drop("rule").dropDuplicates(list(POSITION))
    stage = scratch_path(spark)
    try:
        return _replay(spark, layout, key, (silver, others, settle(once, stage)), lookup)
    finally:
        remove_scratch(spark, stage)


def _replay(
    spark: SparkSession, layout: Layout, key: RunKey, parts: tuple[DataFrame, DataFrame, DataFrame], lookup: Lookup
) -> LoadReport:
    """Write a silver month anew from its rows, its rejects under other rules, and those under a location
    rule, each once: of these, rows that ``lookup`` knows now move to silver."""
    silver, others, located = parts
    located, names = step_aside(located)
    flagged = with_known_flags(located, lookup)
    judged = classify(flagged, [], location_rules())
    moved = names.back(keep_rows(flagged, location_rules()).drop(*_FLAGS, *POSITION))
    again = names.back(rejected(judged).drop(*_FLAGS))

    def to_place() -> tuple[int, int]:
        rows, twice = judged.agg(F.count(F.lit(1)), F.count_if(F.size(REASONS) > 1)).first()
        return silver.count() + others.count() + rows, twice

    split = Split(silver.unionByName(moved.select(*_columns(silver))), others.unionByName(again))
    return _write_month(spark, layout, key, split, to_place)


def _columns(df: DataFrame) -> list[Column]:
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def unplaced_rows(spark: SparkSession, layout: Layout, key: RunKey) -> DataFrame:
    """Rows of a raw month that silver and its quarantine do not hold, and rows that they hold but raw
    does not: none, after a load. Compared as whole rows by bucket checksums, so a good month is
    scanned but not shuffled (its rejects are, to count a row with two reasons once)."""
    raw = read_partition(spark, layout.raw_facts, key)
    raw = keep_clear_of_directories(local_times(conform(raw, SILVER_CONTRACT), SILVER_CONTRACT), POSITION)
    placed = read_partition(spark, layout.silver_facts, key).select(*_columns(raw))
    rejects = read_month_rejects(spark, layout.quarantine, LAYER, key)
    if rejects is not None:
        placed = placed.unionByName(rejects.dropDuplicates(list(POSITION)).select(*_columns(raw)))
    return reconcile(raw, placed)


def classify_raw(raw: DataFrame, lookup: Lookup) -> DataFrame:
    """Every row with its destination: ``silver``, or one row per rule it fails."""
    flagged = with_known_flags(raw, lookup)
    classified = classify(flagged, business_rules(), location_rules())
    found = F.when(F.size("_reasons") == 0, F.array(F.lit(LAYER))).otherwise(F.col("_reasons"))
    return classified.withColumn("destination", F.explode(found)).drop("_reasons", *_FLAGS)
