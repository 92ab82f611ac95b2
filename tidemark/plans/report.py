"""Row counts of a load."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from tidemark.model import RunKey
from tidemark.sinks.tables import count_rows, count_rules
from tidemark.sources.versions import version_path


class LostRowsError(RuntimeError):
    """A load did not place every row that landed."""


@dataclass(frozen=True)
class LoadReport:
    kept: int
    rejected: dict[str, int] = field(default_factory=dict)
    drift: tuple[tuple, ...] = ()
    landed: int | None = None

    def check_conserved(self, where: str, twice: int = 0) -> None:
        """Raise ``LostRowsError`` unless every landed row was kept or rejected, exactly once but for
        ``twice`` rows that two rules reject."""
        placed = self.kept + sum(self.rejected.values()) - twice
        if placed != self.landed:
            raise LostRowsError(f"{where}: {self.landed} rows landed, {placed} were written")

    def steps(self) -> list[tuple[str, int]]:
        """Rows left after each sequential rule, starting from the landed rows."""
        rows = self.landed
        left = [("input", rows)]
        for rule, count in self.rejected.items():
            rows -= count
            left.append((rule, rows))
        return left


def report_load(
    spark: SparkSession,
    facts: str,
    quarantine: str,
    layer: str,
    key: RunKey,
    rules: Iterable[str],
    version: str,
    drift: Iterable[tuple] = (),
    landed: int | None = None,
) -> LoadReport:
    """What a load wrote as ``version`` of its month.

    Counted from the footers of the files just written, so the load itself is not evaluated again
    and tasks that ran twice after a lost executor are not counted twice.
    """
    rejected = count_rules(spark, version_path(f"{quarantine}/layer={layer}", key, version))
    kept = count_rows(spark, version_path(facts, key, version))
    return LoadReport(kept, {r: rejected.get(r, 0) for r in rules}, tuple(drift), landed)
