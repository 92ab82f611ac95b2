"""Near-duplicates by SimHash fingerprints, found through a Golay code.

A fingerprint of 64 bits is cut into three segments, each read as a word of the perfect Golay code
of length 23, in which every word lies within three errors of exactly one codeword. Two words one
error apart need not decode to the same codeword, but one of them always decodes to the codeword of
a word in the other's neighbourhood, of which there are one or six. So each fingerprint asks with
one codeword index and is filed under all indices of its neighbourhood.

With at most two differing bits in three segments, some segment has none and the next or the one
after it (cyclically) has at most one: of two wrong segments, each has one error and the third has
none; of one wrong segment, both others are right. Checking all cases, a segment without error that
is followed by one with at most one error always exists. The join key is therefore the number of a
segment, its bits, and a codeword index of the following segment: 33 or more bits. Every match is
verified on the whole fingerprint.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import components
from tidemark.sources.scratch import scratch_path, settle

SHINGLE = 3
BITS = 2
SEED = 42
SEGMENTS = (22, 21, 21)  # bits, from the lowest
# Generator polynomial of the Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
LENGTH, DATA = 23, 12
AT_ONCE = 1 << 14


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """A bit is set if it is set in over half of the shingles' hashes; zero without words."""
    words = text.lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    places = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    total = len(words) - size + 1
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in places), "<u8", total)
    ones = np.zeros(64, np.int64)
    for start in range(0, total, AT_ONCE):
        part = hashes[start : start + AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


@functools.lru_cache(maxsize=1)
def decoding() -> np.ndarray:
    """The index of the nearest codeword of each word of 23 bits."""
    data = np.arange(1 << DATA, dtype=np.int64) << (LENGTH - DATA)
    rest = data.copy()
    for bit in range(LENGTH - 1, LENGTH - DATA - 1, -1):
        rest ^= np.where(rest >> bit & 1, GENERATOR << (bit - LENGTH + DATA), 0)
    codewords = data | rest
    table = np.full(1 << LENGTH, -1, np.int16)
    errors = [0]
    errors += [1 << i for i in range(LENGTH)]
    errors += [1 << i | 1 << j for i in range(LENGTH) for j in range(i)]
    errors += [1 << i | 1 << j | 1 << k for i in range(LENGTH) for j in range(i) for k in range(j)]
    for error in errors:
        table[codewords ^ error] = np.arange(1 << DATA)
    return table


def segments(prints: np.ndarray) -> list[np.ndarray]:
    found, shift = [], 0
    for bits in SEGMENTS:
        found.append((prints >> np.uint64(shift) & np.uint64((1 << bits) - 1)).astype(np.int64))
        shift += bits
    return found


def keys(prints: np.ndarray, neighbourhood: bool) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``prints``, key) pairs without repeats: one key per segment to ask with, or
    all keys to be filed under."""
    table, parts = decoding(), segments(prints)
    where, out = [], []
    for number, exact in enumerate(parts):
        following = parts[(number + 1) % len(parts)]
        masks = [0, *(1 << i for i in range(LENGTH))] if neighbourhood else [0]
        indices = np.sort(np.stack([table[following ^ m] for m in masks], axis=1), axis=1).astype(np.int64)
        new = np.ones(indices.shape, bool)
        new[:, 1:] = indices[:, 1:] != indices[:, :-1]
        rows, columns = np.nonzero(new)
        where.append(rows)
        out.append((number << 40) | (exact[rows] << DATA) | indices[rows, columns])
    return np.concatenate(where), np.concatenate(out)


def _prints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            prints = np.array([fingerprint(t or b"", shingle) for t in texts], np.uint64).view(np.int64)
            name = next(n for n in batch.schema.names if n != "text")
            yield pa.RecordBatch.from_arrays([batch.column(name), pa.array(prints)], [name, "print"])

    return run


def _filed(neighbourhood: bool, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy()
            for start in range(0, len(prints), AT_ONCE):
                part = prints[start : start + AT_ONCE]
                rows, found = keys(part.view(np.uint64), neighbourhood)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(part[rows])], ["key", name])

    return run


def links(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """Pairs ``a`` < ``b`` of the distinct integers ``print`` that differ in at most ``bits`` bits.

    ``bits`` may be at most two, for which the code gives every pair.
    """
    if bits > BITS:
        raise ValueError("the keys find pairs up to two differing bits")
    asks = prints.mapInArrow(_filed(False, "a"), "key bigint, a bigint")
    files = prints.mapInArrow(_filed(True, "b"), "key bigint, b bigint")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits
    # Either of two may be the one that asks; the smaller one does.
    return asks.join(files, "key").where((F.col("a") < F.col("b")) & close).select("a", "b").distinct()


def classes(rows: DataFrame, order: Column, bits: int = BITS) -> DataFrame:
    """``print`` and the least ``order`` of its class, as ``least``."""
    spark = rows.sparkSession
    prints = settle(rows.groupBy("print").agg(F.min(order).alias("own")), scratch_path(spark))
    found = components(links(prints.select("print"), bits))
    rooted = prints.join(found.withColumnRenamed("node", "print"), "print", "left").withColumn(
        "root", F.coalesce("root", "print")
    )
    least = rooted.groupBy("root").agg(F.min("own").alias("least"))
    return settle(rooted.join(least, "root").select("print", "least"), scratch_path(spark))


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bits: int = BITS
) -> DataFrame:
    """``id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id``, the smallest identifier
    of the rows reached over links.

    One row per row of ``docs``, repeated identifiers included. Texts without words, null ones
    among them, have the fingerprint zero. Null identifiers are in a class like all others, but are
    only its identifier where it has no other. An empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("print", T.LongType())])
    rows = rows.mapInArrow(_prints(shingle), schema)
    rows = settle(rows, scratch_path(docs.sparkSession))
    found = classes(rows, F.col("id"), bits)
    return rows.join(found, "print").select(
        F.col("id").alias(id),
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        F.col("least").alias("component_id"),
    )


def drop_near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bits: int = BITS
) -> DataFrame:
    """The rows of ``docs``, unchanged, that have the smallest identifier of their class.

    Exactly one row per class stays, also where identifiers repeat or are null (null ones come last).
    """
    spark = docs.sparkSession
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{text}`").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("print", T.LongType())])
    rows = rows.mapInArrow(_prints(shingle), schema)
    rows = rows.withColumn("place", F.monotonically_increasing_id())
    rows = settle(rows, scratch_path(spark))
    narrow = rows.select("print", "place", F.col("row")[id].alias("id"))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "place")
    keep = classes(narrow, order, bits).select(F.col("least.place").alias("place")).distinct()
    return rows.join(keep, "place", "left_semi").select("row.*")
