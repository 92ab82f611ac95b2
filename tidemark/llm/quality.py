"""Quality rules whose cutoffs are risk-controlled on labelled documents.

A rule rejects a document when one of its ratios exceeds the cutoff of the document's stratum. The
labelled documents that pass the base rules are the holdout: nothing is fitted on them but the
cutoffs. Level j takes the j-th cutoff of every rule, so each level rejects all that the milder ones
do. In each stratum the levels are tried from the mildest to the strictest. A level is safe when the
exact binomial test at the allowed rate of false rejections rejects the hypothesis of a higher rate,
that is, when the Clopper-Pearson upper bound of good documents rejected by any of its cutoffs is at
most that rate. Trying stops at the first level that is not safe (fixed-sequence testing, which needs
no correction along the sequence); over strata the error level is divided (Bonferroni). So with
probability ``1 - ERROR`` no stratum loses more than ``FALSE_REJECTIONS`` of its good documents that
pass the base rules. A stratum with too few labels gets no cutoff and loses none.

One rule that good documents of a stratum break would hold the others back there. Where the labels
suffice to test each rule alone as well, at its share of the rate, half of the error level goes to
such sequences of single rules, and those cutoffs are taken if they are more levels in all. Whether
the labels suffice depends on their number only, so the guarantee stays.
"""

from __future__ import annotations

import functools
import math
import operator
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.scratch import scratch_path, settle

WINDOW = 5
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")
# Ratio of two counts -> cutoffs, mildest first.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "upper": ("n_upper", "word_chars"),
    "marks": ("n_marks", "n_words"),
    "lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
}
CUTOFFS = {
    "symbols": (0.3, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02),
    "upper": (0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15),
    "marks": (2.0, 1.5, 1.2, 1.0, 0.8, 0.6, 0.5, 0.4),
    "lines": (0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35),
    "repeats": (0.9, 0.7, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15),
}
LEVELS = 8
FALSE_REJECTIONS = 0.02
ERROR = 0.05


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that are found at least twice in ``words``, the first one included."""
    grams = list(zip(*(words[i:] for i in range(window))))
    if len(set(grams)) == len(grams):
        return 0
    found = Counter(grams)
    again = np.fromiter((found[g] > 1 for g in grams), np.int8, len(grams))
    steps = np.zeros(len(words) + 1, np.int64)
    steps[: len(grams)] += again
    steps[window : window + len(grams)] -= again
    return int((np.cumsum(steps) > 0).sum())


def counts(text: str) -> tuple[int, ...]:
    """The ``COUNTS`` of a whole text; words are runs between ASCII white space."""
    data = text.encode()
    words = data.split()
    spaces = len(data) - len(data.translate(None, b" \t\n\v\f\r"))
    lines = [line for line in data.split(b"\n") if line.strip()]
    upper = sum(map(str.isupper, text)) if not text.isascii() else len(data) - len(
        data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    )
    return (
        len(words),
        len(text) - spaces,
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(lines),
        upper,
        len(data) - len(data.translate(None, b".!?")),
    )


def _measure(text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [counts(t.as_py() or "") for t in batch.column("row").field(text)]
            columns = zip(*rows) if rows else [[] for _ in COUNTS]
            arrays = [pa.array(c, pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *arrays], ["row", *COUNTS])

    return run


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Each row of ``docs`` as the struct ``row``, beside its ``COUNTS``. Null texts have no words."""
    rows = docs.select(F.struct("*").alias("row"))
    schema = T.StructType([*rows.schema.fields, *(T.StructField(c, T.LongType()) for c in COUNTS)])
    return rows.mapInArrow(_measure(text), schema)


def binomial_below(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p), for k below the mean; 1 otherwise."""
    if k >= n * p:
        return 1.0
    term = math.exp(
        math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    )
    total, i = term, k
    while i > 0 and term > total * 1e-17:
        term *= i * (1 - p) / ((n - i + 1) * p)
        total += term
        i -= 1
    return total


def safe(rejected: int, good: int, rate: float, error: float) -> bool:
    """Whether the exact upper bound, at level ``error``, of the rejected share is at most ``rate``."""
    return good > 0 and binomial_below(rejected, good, rate) <= error


def _level(rejected: list[int], good: int, rate: float, error: float) -> int:
    """How many levels are safe, up to the first that is not."""
    for j, k in enumerate(rejected):
        if not safe(k, good, rate, error):
            return j
    return len(rejected)


def levels(any_rule: list[int], single: dict[str, list[int]], good: int, rate: float, error: float) -> dict[str, int]:
    """The level of each rule in a stratum, 0 for none.

    ``any_rule`` and ``single`` have the good documents rejected at each level.
    """
    share, part = rate / len(RULES), error / 2 / len(RULES)
    enough = safe(0, good, share, part)
    joint = dict.fromkeys(RULES, _level(any_rule, good, rate, error / 2 if enough else error))
    if not enough:
        return joint
    alone = {rule: _level(single[rule], good, share, part) for rule in RULES}
    return max(joint, alone, key=lambda found: sum(found.values()))


def _choose(rate: float, error: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {f"cut_{r}": [] for r in RULES}
            for row in batch.to_pylist():
                single = {r: [row[f"{r}_{j}"] for j in range(LEVELS)] for r in RULES}
                found = levels([row[f"any_{j}"] for j in range(LEVELS)], single, row["good"], rate, error)
                for rule, level in found.items():
                    out[f"cut_{rule}"].append(CUTOFFS[rule][level - 1] if level else None)
            arrays = [batch.column("stratum"), *(pa.array(v, pa.float64()) for v in out.values())]
            yield pa.RecordBatch.from_arrays(arrays, ["stratum", *out])

    return run


def _base_failed():
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _ratio(rule: str):
    above, below = RULES[rule]
    return F.when(F.col(below) > 0, F.col(above) / F.col(below)).otherwise(F.lit(0.0))


def cutoffs(
    features: DataFrame, labels: DataFrame, rate: float = FALSE_REJECTIONS, error: float = ERROR
) -> DataFrame:
    """The cutoff of each rule per ``stratum``; null, or no row, where none is safe.

    ``features`` has ``id``, ``stratum`` and the counts; ``labels`` has ``id`` and ``quality``.
    A document that any of its labels calls good is good; null labels and identifiers say nothing.
    """
    good = labels.where(F.col("quality") == 1).select("id").distinct()
    held = features.where(~_base_failed()).join(good, "id", "left_semi")
    tries = []
    for j in range(LEVELS):
        over = {rule: _ratio(rule) > F.lit(CUTOFFS[rule][j]) for rule in RULES}
        over["any"] = functools.reduce(operator.or_, over.values())
        tries += [F.sum(c.cast("bigint")).alias(f"{name}_{j}") for name, c in over.items()]
    table = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("good"), *tries)
    table = settle(table, scratch_path(features.sparkSession))
    strata = max(1, table.count())
    schema = "stratum string, " + ", ".join(f"cut_{r} double" for r in RULES)
    return table.mapInArrow(_choose(rate, error / strata), schema)


def judged(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", stratum: str = "lang"
) -> DataFrame:
    """Each row of ``docs`` as the struct ``row`` with its counts, ``base_failed`` and ``kept``.

    ``base_failed``: under ten words, or over a fifth of the words in repeated windows. ``kept`` is
    false for these and for rows above a cutoff. Null strata form one of their own. An empty table
    gives no rows, and without labels only the base rules reject.
    """
    rows = settle(measured(docs, text), scratch_path(docs.sparkSession))
    rows = rows.withColumn("stratum", F.coalesce(F.col("row")[stratum].cast("string"), F.lit("")))
    features = rows.select(F.col("row")[id].alias("id"), "stratum", *COUNTS)
    marked = labels.select(F.col(id).alias("id"), "quality")
    chosen = settle(cutoffs(features, marked), scratch_path(docs.sparkSession))
    # A stratum with a cutoff has hundreds of labelled rows; Spark broadcasts the table if it is small.
    over = F.lit(False)
    for rule in RULES:
        over = over | F.coalesce(_ratio(rule) > F.col(f"cut_{rule}"), F.lit(False))
    base = _base_failed()
    return (
        rows.join(chosen, "stratum", "left")
        .withColumn("base_failed", base)
        .withColumn("kept", ~(base | over))
        .drop("stratum", *(f"cut_{r}" for r in RULES))
    )


def drop_low_quality(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that every rule keeps, unchanged."""
    return judged(docs, labels, id, text).where("kept").select("row.*")
