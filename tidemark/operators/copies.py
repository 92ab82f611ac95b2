"""Whole-row duplicates and set differences, safe when one group holds much of the table.

Everything here groups with a partial (map-side) aggregate, so a hot row collapses to one record
per map task before the shuffle. Copies travel as a count and are only written out again at the
end, in blocks that are spread over the tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.names import aside

COPIES = "_copies"
_SIDE = "_side"
# Up to SMALL copies are written out where the group is; larger groups are cut into blocks of
# BLOCK copies which are shuffled, so no single task has to write a whole hot group.
SMALL = 64
BLOCK = 65_536
# A filter marks repeated fingerprints in blocks of eight 64-bit words, one bit in each. It has
# BITS_EACH bits or more per repeated fingerprint, which leaves below 1 % of unique rows marked, up to
# BLOCKS blocks: some 100 MB as a broadcast table, whatever the size of the data.
LANES = 8
BITS_EACH = 12
BLOCKS = 1 << 20
_FP = "_fp"
_BLOCK = "_block"


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{name}`") for name in names]


def count_copies(df: DataFrame, aside: str | None = None) -> DataFrame:
    """One row per distinct row with its number of copies. NULLs, NaNs and zeros compare equal.

    The column ``aside`` does not tell rows apart; its smallest value is kept. It should be a
    number: a string minimum would turn the aggregation into a sort, of every copy of a hot row.
    """
    data = [c for c in df.columns if c != aside]
    kept = [] if aside is None else [F.min(f"`{aside}`").alias(aside)]
    return df.groupBy(*_cols(data)).agg(F.count(F.lit(1)).alias(COPIES), *kept)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def replicate(df: DataFrame, copies: str = COPIES) -> DataFrame:
    """Write each row out ``copies`` times (not at all for 0 or less) and drop the count.

    The two branches read the same aggregate, whose exchange Spark reuses.
    """
    spark = df.sparkSession
    n = F.col(copies)
    data = [c for c in df.columns if c != copies]
    few = (
        df.where((n >= 1) & (n <= SMALL))
        .select(*_cols(data), F.explode(F.sequence(F.lit(1), n.cast("int"))).alias("_i"))
        .drop("_i")
    )
    # A fixed number of partitions: adaptive coalescing would judge blocks by their packed size.
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    last_block = F.floor((n - 1) / F.lit(BLOCK)).cast("bigint")
    many = (
        df.where(n > SMALL)
        .select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)).alias("_block"))
        .withColumn("_size", F.least(F.lit(BLOCK).cast("bigint"), n - F.col("_block") * BLOCK))
        .drop(copies)
        .repartition(partitions, "_block", *_cols(data))
        .select(*_cols(data), F.explode(F.sequence(F.lit(1), F.col("_size").cast("int"))).alias("_i"))
        .drop("_i")
    )
    return few.unionAll(many)


@aside
def surplus_copies(df: DataFrame) -> DataFrame:
    """Every copy of a row beyond its first: n equal rows give n - 1. One scan, one shuffle."""
    counted = count_copies(df).where(F.col(COPIES) > 1)
    return replicate(counted.withColumn(COPIES, F.col(COPIES) - 1))


@aside
def bag_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Multiset difference: each row of ``left`` as often as it exceeds ``right``."""
    both = left.withColumn(_SIDE, F.lit(1)).unionAll(right.withColumn(_SIDE, F.lit(-1)))
    counted = both.groupBy(*_cols(left.columns)).agg(F.sum(_SIDE).alias(COPIES))
    return replicate(counted.where(F.col(COPIES) > 0))


@aside
def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that are not in ``right``; NULLs compare equal.

    One partially aggregated grouping of both sides instead of an anti join, so rows that repeat
    on either side never meet in one task.
    """
    both = left.withColumn(_SIDE, F.lit(0)).unionAll(right.withColumn(_SIDE, F.lit(1)))
    seen = both.groupBy(*_cols(left.columns)).agg(F.max(_SIDE).alias(_SIDE))
    return seen.where(F.col(_SIDE) == 0).drop(_SIDE)


def fingerprint(columns: Sequence[str]) -> Column:
    """64-bit hash that equal rows share. Different rows may share it too, so it only ever
    selects candidates for an exact grouping."""
    return F.xxhash64(*_cols(columns))


def repeated_fingerprints(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fingerprints carried by more than one row. Shuffles 8-byte keys instead of whole rows."""
    return (
        df.select(fingerprint(columns).alias(_FP))
        .groupBy(_FP)
        .agg(F.count(F.lit(1)).alias(COPIES))
        .where(F.col(COPIES) > 1)
        .select(_FP)
    )


def filter_blocks(repeats: int, most: int = BLOCKS) -> int:
    """Blocks of a filter for so many fingerprints: a power of two, at most ``most``."""
    wanted = max(1, -(-repeats * BITS_EACH // (64 * LANES)))
    return min(most, 1 << (wanted - 1).bit_length())


def _lane(number: int) -> str:
    return f"_lane{number}"


def _block(blocks: int) -> Column:
    return F.col(_FP).bitwiseAND(F.lit(blocks - 1).cast("bigint"))


def _bit(number: int) -> Column:
    """Six bits of a second hash, so that they are independent of the block."""
    return F.shiftrightunsigned(F.xxhash64(_FP), 6 * number).bitwiseAND(F.lit(63).cast("bigint")).cast("int")


def mark_repeats(repeats: DataFrame, blocks: int) -> DataFrame:
    """Repeated fingerprints as a blocked Bloom filter: at most ``blocks`` rows (a power of two).

    A fingerprint sets one bit in each lane of the block that its low bits name. No repeated
    fingerprint is ever unmarked; a unique one is marked if its eight bits happen to be set, too.
    """
    bits = repeats.select(
        _block(blocks).alias(_BLOCK),
        *[F.call_function("shiftleft", F.lit(1).cast("bigint"), _bit(i)).alias(_lane(i)) for i in range(LANES)],
    )
    return bits.groupBy(_BLOCK).agg(*[F.bit_or(_lane(i)).alias(_lane(i)) for i in range(LANES)])


def split_marked(
    df: DataFrame, columns: Sequence[str], marks: DataFrame, blocks: int
) -> tuple[DataFrame, DataFrame]:
    """``df`` in two: rows that are certainly unique, and candidates, among which is every row that
    repeats. Both sides are narrow; ``marks`` is a table of ``mark_repeats`` of as many ``blocks``."""
    hashed = df.withColumn(_FP, fingerprint(columns)).withColumn("_at", _block(blocks))
    looked_up = hashed.join(F.broadcast(marks), F.col("_at") == F.col(_BLOCK), "left")
    every_bit = reduce(Column.__and__, [F.getbit(_lane(i), _bit(i)) == 1 for i in range(LANES)])
    marked = F.coalesce(every_bit, F.lit(False))
    own = _cols(df.columns)
    return looked_up.where(~marked).select(*own), looked_up.where(marked).select(*own)
