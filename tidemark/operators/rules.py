"""Quality rules as data, and the classifier that applies them in one pass.

A rule says when a row is bad. ``null_is_bad`` decides what an unknown (NULL) answer means, so
callers never have to. Kept and rejected rows are both read off the same expressions, which makes
the two sides complements of each other without any set operation or shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import floor_second, in_month
from tidemark.model import RunKey

REASONS = "_reasons"


@dataclass(frozen=True)
class Rule:
    name: str
    bad: Column
    null_is_bad: bool = False

    def rejects(self) -> Column:
        return F.coalesce(self.bad, F.lit(self.null_is_bad))

    def keeps(self) -> Column:
        """Filter for the good rows. With ``null_is_bad`` it stays a plain negation, which
        Catalyst can turn into pushed-down comparisons (a filter drops NULL answers anyway)."""
        return ~self.bad if self.null_is_bad else ~self.rejects()


def _named(column: str) -> Column:
    return F.col(f"`{column}`")


def null_rule(name: str, schema: T.StructType, subset: Iterable[str] | None = None) -> Rule:
    """Any column NULL; NaN counts as NULL in floating-point columns."""
    columns = list(subset) if subset is not None else schema.fieldNames()
    tests = []
    for column in columns:
        test = _named(column).isNull()
        if isinstance(schema[column].dataType, T.DoubleType | T.FloatType):
            test = test | F.isnan(_named(column))
        tests.append(test)
    # The tests never answer NULL, so the kept side can be the plain, pushable negation.
    return Rule(name, reduce(Column.__or__, tests), null_is_bad=True)


def range_rule(name: str, columns: Sequence[str], low: int, high: int) -> Rule:
    """Any column outside ``low``..``high`` (both included), or NULL."""
    inside = [_named(c).between(low, high) for c in columns]
    return Rule(name, ~reduce(Column.__and__, inside), null_is_bad=True)


def month_rule(name: str, column: str, key: RunKey, dtype: T.DataType | None = None) -> Rule:
    """Time outside the run's month, or NULL."""
    return Rule(name, ~in_month(_named(column), key, dtype), null_is_bad=True)


def order_rule(name: str, start: str, end: str) -> Rule:
    """``end`` before ``start`` in whole seconds. Equal seconds and NULLs are kept.

    floor(end) < floor(start) holds exactly when end < floor(start), so one side is floored, and
    only for the rows that the cheap comparison leaves open.
    """
    first, last = _named(start), _named(end)
    return Rule(name, (last < first) & (last < floor_second(first)))


def zero_rule(name: str, column: str) -> Rule:
    """Value is zero; NULL is kept.

    The test runs on the absolute value as a double: that equals 0 for -0.0 too, and it cannot be
    pushed into a Parquet scan, whose zero statistics and dictionaries would lose -0.0 rows.
    """
    return Rule(name, F.abs(_named(column).cast("double")) == F.lit(0.0))


def unknown_rule(name: str, known_flag: str) -> Rule:
    """A lookup found no match: the flag column of ``lookups.flag_known`` is not true."""
    return Rule(name, ~_named(known_flag), null_is_bad=True)


def reasons(sequential: Sequence[Rule], parallel: Sequence[Rule] = ()) -> Column:
    """Array of the rule names a row fails.

    Of the sequential rules only the first failing one counts. Rows that pass them all get the
    name of every failing parallel rule, so such a row can have several reasons.
    """
    none = F.array().cast("array<string>")
    rest = none
    if parallel:
        rest = F.concat(*[F.when(r.rejects(), F.array(F.lit(r.name))).otherwise(none)
                          for r in parallel])
    if not sequential:
        return rest
    first, *others = sequential
    chain = F.when(first.rejects(), F.array(F.lit(first.name)))
    for rule in others:
        chain = chain.when(rule.rejects(), F.array(F.lit(rule.name)))
    return chain.otherwise(rest)


def classify(df: DataFrame, sequential: Sequence[Rule], parallel: Sequence[Rule] = ()) -> DataFrame:
    """Add the ``_reasons`` array; an empty one means the row is kept. Narrow: no shuffle."""
    return df.withColumn(REASONS, reasons(sequential, parallel))


def kept(classified: DataFrame) -> DataFrame:
    return classified.where(F.size(REASONS) == 0).drop(REASONS)


def rejected(classified: DataFrame, rule_column: str = "rule") -> DataFrame:
    """One row per (row, reason): a row with two reasons comes out twice."""
    if rule_column in classified.columns:
        raise ValueError(f"the data has a column {rule_column} of its own, which would be lost")
    return classified.withColumn(rule_column, F.explode(REASONS)).drop(REASONS)


def rejected_once(df: DataFrame, rules: Sequence[Rule], rule_column: str = "rule") -> DataFrame:
    """One row per rejected row, under the first of the ``rules`` it fails: what ``rejected`` gives for
    sequential rules alone. There is no array to unfold, for which Spark would judge each row again."""
    if rule_column in df.columns:
        raise ValueError(f"the data has a column {rule_column} of its own, which would be lost")
    first, *others = rules
    chain = F.when(first.rejects(), F.lit(first.name))
    for rule in others:
        chain = chain.when(rule.rejects(), F.lit(rule.name))
    return df.withColumn(rule_column, chain).where(F.col(rule_column).isNotNull())


def keep_rows(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Only the rows that pass every rule, as one pushable conjunction."""
    return df.where(reduce(Column.__and__, [r.keeps() for r in rules]))


def reject_rows(df: DataFrame, rule: Rule) -> DataFrame:
    """The rows one rule rejects."""
    return df.where(rule.rejects())
