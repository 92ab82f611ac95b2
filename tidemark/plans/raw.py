"""Landing to raw: one month, de-duplicated, checked and given audit columns."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.model import (
    AUDIT_COLUMNS,
    DROPOFF_LOCATION,
    LANDING_CONTRACT,
    LOCATION_RANGE,
    PICKUP_LOCATION,
    PICKUP_TIME,
    RULE_DUPLICATES,
    RULE_LOCATIONS,
    RULE_NULLS,
    RULE_STRAY,
    TRIP_COLUMNS,
    Layout,
    RunKey,
)
from tidemark.operators.contracts import check_contract, check_types, conform, local_times
from tidemark.operators.copies import (
    BLOCKS,
    COPIES,
    count_copies,
    filter_blocks,
    mark_repeats,
    repeated_fingerprints,
    replicate,
    split_marked,
)
from tidemark.operators.names import keep_clear_of_directories, step_aside
from tidemark.operators.rules import (
    Rule,
    keep_rows,
    month_rule,
    null_rule,
    range_rule,
    rejected_once,
)
from tidemark.plans.report import LoadReport, report_load
from tidemark.sinks.tables import (
    count_rows,
    discard_quarantine,
    link_quarantine,
    many_rejects,
    replace_quarantine,
    tidy_quarantine,
    write_rule,
    write_version,
)
from tidemark.sources.facts import SOURCE_FILE, read_month_file, with_source
from tidemark.sources.scratch import remove_scratch, scratch_path, settle
from tidemark.sources.versions import (
    discard_version,
    new_version,
    switch_month,
    tidy_month,
    version_path,
)

LAYER = "raw"
RULES = (RULE_DUPLICATES, RULE_NULLS, RULE_LOCATIONS, RULE_STRAY)
_FILE = "_file_id"


@dataclass(frozen=True)
class Split:
    """The sides of a load; ``rejects`` has one more column, ``rule``.

    ``surplus`` holds copies beyond the first of a row, if the load looks for them: ``repeated`` rows.
    """

    kept: DataFrame
    rejects: DataFrame
    surplus: DataFrame | None = None
    repeated: int = 0


def landing_rules(
    landing: DataFrame,
    key: RunKey,
    location_range: tuple[int, int] = LOCATION_RANGE,
    null_subset: Iterable[str] | None = None,
) -> list[Rule]:
    """Null, range and period rule, in the order in which they claim a row."""
    return [
        null_rule(RULE_NULLS, landing.schema, null_subset),
        range_rule(RULE_LOCATIONS, [PICKUP_LOCATION, DROPOFF_LOCATION], *location_range),
        month_rule(RULE_STRAY, PICKUP_TIME, key, landing.schema[PICKUP_TIME].dataType),
    ]


@dataclass(frozen=True)
class Copies:
    """Which landed rows may repeat.

    ``marks`` is the filter of their fingerprints (None: no row repeats) of so many ``blocks``,
    ``groups`` one row per distinct candidate with its number of copies and file name.
    """

    marks: DataFrame | None = None
    groups: DataFrame | None = None
    blocks: int = 0

    def distinct(self, landing: DataFrame) -> DataFrame:
        """One row per distinct row of ``landing``, which may have the file name or not."""
        if self.groups is None:
            return landing
        unique, _ = split_marked(landing, _data(landing), self.marks, self.blocks)
        return unique.unionAll(self.groups.select([f"`{c}`" for c in landing.columns]))

    def surplus(self) -> DataFrame | None:
        if self.groups is None:
            return None
        more = self.groups.where(F.col(COPIES) > 1).withColumn(COPIES, F.col(COPIES) - 1)
        return replicate(more.drop(SOURCE_FILE))

    def repeated(self) -> int:
        """Rows of ``surplus``."""
        return 0 if self.groups is None else self.groups.agg(F.sum(F.col(COPIES) - 1)).first()[0] or 0


def _data(landing: DataFrame) -> list[str]:
    return [c for c in landing.columns if c != SOURCE_FILE]


def find_copies(landing: DataFrame, stage: str, most_blocks: int = BLOCKS) -> Copies:
    """Look for whole-row copies by shuffling 8-byte fingerprints.

    Rows whose fingerprint is not marked as repeated are certainly unique and never shuffled. The
    candidates are grouped exactly on all data columns, in one shuffle of theirs. The file name is
    not part of the grouping: it travels as its hash, the smallest is kept, and the few names are
    joined back to the groups.
    """
    repeats = settle(repeated_fingerprints(landing, landing.columns), f"{stage}/fingerprints")
    repeated = repeats.count()
    if not repeated:
        return Copies()
    blocks = filter_blocks(repeated, most_blocks)
    marks = settle(mark_repeats(repeats, blocks), f"{stage}/marks")
    named = with_source(landing)
    file_id = F.xxhash64(SOURCE_FILE)
    # Counted, so that the names are gathered by hash: a mere distinct below the minimum of a string is
    # left out by Spark, which then sorts every row of a task.
    names = named.groupBy(SOURCE_FILE).agg(F.count(F.lit(1)).alias(COPIES)).where(F.col(COPIES) > 0)
    files = settle(
        names.groupBy(file_id.alias(_FILE)).agg(F.min(SOURCE_FILE).alias(SOURCE_FILE)), f"{stage}/files"
    )
    _, candidates = split_marked(named, landing.columns, marks, blocks)
    counted = count_copies(candidates.withColumn(_FILE, file_id).drop(SOURCE_FILE), _FILE)
    groups = settle(counted.join(files, _FILE).drop(_FILE), f"{stage}/groups")
    return Copies(marks, groups, blocks)


def split_landing(
    landing: DataFrame, rules: list[Rule], stage: str, most_blocks: int = BLOCKS
) -> Split:
    """Surplus copies go first; of each distinct row, one copy goes through the other rules.

    ``landing`` must come from a file scan, which knows the file names of the kept rows. A kept row
    passes every rule in whichever order, so the last one is asked first: a load's period leaves few
    rows for the null rule, which tests every column.
    """
    copies = find_copies(landing, stage, most_blocks)
    return Split(
        keep_rows(copies.distinct(with_source(landing)), rules[::-1]),
        rejected_once(copies.distinct(landing), rules),
        copies.surplus(),
        copies.repeated(),
    )


def with_audit(kept: DataFrame) -> DataFrame:
    """Data columns, then the ingestion time and the source file name, which replace landed columns
    of these names."""
    ingested, source = AUDIT_COLUMNS.fieldNames()
    data = [f"`{c}`" for c in kept.columns if c not in (SOURCE_FILE, ingested, source)]
    return kept.select(*data, F.current_timestamp().alias(ingested), F.col(SOURCE_FILE).alias(source))


class RejectedShareError(RuntimeError):
    """A load would reject more of a month than its caller allows; the month was not switched."""


def load_raw(
    spark: SparkSession,
    layout: Layout,
    key: RunKey,
    location_range: tuple[int, int] = LOCATION_RANGE,
    null_subset: Iterable[str] | None = None,
    most_rejected: float = 1.0,
) -> LoadReport:
    """Load one landed month into raw and quarantine what fails. Replaces the month in one step.

    Facts and rejects are written as a new version; when every landed row is placed, and no larger
    share than ``most_rejected`` of them is rejected, the version becomes the current one. A load
    that fails before leaves raw and quarantine as they were.

    Landed columns keep their values whatever their names. Those that directories name (``year``,
    ``month``, ``layer``, ``rule``) are written as ``landed_year`` and so on.
    """
    path = layout.landing_file(key)
    landing = read_month_file(spark, path, key)
    check_contract(landing, LANDING_CONTRACT, path)
    landing = conform(landing, TRIP_COLUMNS)
    check_types(local_times(landing, TRIP_COLUMNS), TRIP_COLUMNS, path)
    landing, names = step_aside(keep_clear_of_directories(landing))
    landed = landing.count()
    subset = None if null_subset is None else [names.name(c) for c in null_subset]
    stage, version = scratch_path(spark), new_version()
    rules = landing_rules(landing, key, location_range, subset)

    def written(side: DataFrame) -> DataFrame:
        return names.back(local_times(side, TRIP_COLUMNS))

    try:
        split = split_landing(landing, rules, stage)
        kept = written(with_audit(split.kept))
        write_version(kept, layout.raw_facts, key, version)
        rejects = landed - split.repeated - count_rows(spark, version_path(layout.raw_facts, key, version))
        replace_quarantine(
            written(split.rejects), layout.quarantine, LAYER, key, version, many_rejects(rejects, landed)
        )
        if split.surplus is not None:
            write_rule(written(split.surplus), layout.quarantine, LAYER, key, RULE_DUPLICATES, version)
        report = report_load(
            spark, layout.raw_facts, layout.quarantine, LAYER, key, RULES, version, landed=landed
        )
        report.check_conserved(path)
        if sum(report.rejected.values()) > most_rejected * landed:
            raise RejectedShareError(f"{path}: {report.rejected} of {landed} rows rejected")
        link_quarantine(spark, layout.quarantine, LAYER, layout.raw_facts)
        switch_month(spark, layout.raw_facts, key, version, kept.schema)
    except Exception:
        discard_version(spark, layout.raw_facts, key, version)
        discard_quarantine(spark, layout.quarantine, LAYER, key, version)
        raise
    finally:
        remove_scratch(spark, stage)
    tidy_month(spark, layout.raw_facts, key)
    tidy_quarantine(spark, layout.quarantine, LAYER, key)
    return report
