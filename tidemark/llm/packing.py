"""Packing of token sequences: first-fit decreasing in randomised groups of pieces.

Documents are cut at the sequence length. Full pieces are sequences of their own and are in no group;
the rests, each shorter than a sequence and at most one per document, are dealt to random groups of
bounded expected size, and each group is packed by first-fit decreasing, with a tournament tree over
the room left in its bins to find the first bin that fits in logarithmic time. A rest is never cut again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import pack as pack_rows
from tidemark.llm.tokens import encoder
from tidemark.sources.scratch import scratch_path, settle

LENGTH = 2048
GROUP_PIECES = 2048
SEED = 20
# Sequences of one group are numbered in steps of this many; a group has far fewer.
GROUP_SPAN = 1 << 24


class Tournament:
    """Room left in bins 0, 1, 2, ...; every inner node holds the larger room of its children."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def first_fit(self, size: int) -> int:
        """Put ``size`` into the first bin that has the room, and return the bin."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        room[node] -= size
        bin = node - self.leaves
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
        return bin


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Items of each bin, by position in ``sizes``. Equal sizes keep their order."""
    tree = Tournament(len(sizes), capacity)
    bins: list[list[int]] = []
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        bin = tree.first_fit(sizes[item])
        if bin == len(bins):
            bins.append([])
        bins[bin].append(item)
    return bins


def _pieces(tokenizer: str, id: str, end: int, length: int):
    """Batches of (doc_id, row) texts -> pieces; the ids of full pieces are only summed up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        last = np.array([end], dtype=enc.dtype)
        for batch in batches:
            for block, found in enc.in_blocks(batch, "text"):
                out = {"id": [], "start": [], "ids": [], "crc": [], "size": [], "total": []}
                for i, doc in enumerate(block.column("id").to_pylist()):
                    ids = np.concatenate([found[i], last]).astype("<u4")
                    for start in range(0, len(ids), length):
                        piece = ids[start : start + length]
                        whole = len(piece) == length
                        out["id"].append(doc)
                        out["start"].append(start)
                        out["ids"].append(None if whole else piece.astype(enc.dtype).tobytes())
                        out["crc"].append(zlib.crc32(piece) if whole else None)
                        out["size"].append(len(piece))
                        out["total"].append(len(ids))
                types = [block.schema.field("id").type, pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, type=t) for v, t in zip(out.values(), types)], list(out)
                )

    return run


def _pack(length: int, width: int):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        columns = [group.column(c).to_pylist() for c in ("id", "start", "size", "total", "ids")]
        # The order within the group must not depend on how rows arrived.
        pieces = sorted(zip(*columns), key=lambda p: (p[0] is not None, p[0] or 0, *p[1:4], p[4]))
        found = first_fit_decreasing([p[2] for p in pieces], length)
        out = []
        for number, items in enumerate(found):
            offset = 0
            for item in items:
                doc, start, size, total, ids = pieces[item]
                crc = zlib.crc32(np.frombuffer(ids, f"<u{width}").astype("<u4"))
                out.append((doc, start, size, crc, total, key[0].as_py() * GROUP_SPAN + number, offset))
                offset += size
        names = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
        fields = [group.schema.field("id"), *(pa.field(n, pa.int64()) for n in names)]
        return pa.Table.from_batches([pack_rows(out, pa.schema(fields))])

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    end: int,
    id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """Where each piece of each document lies: columns ``id``, start, length, ids_crc32,
    doc_tokens, sequence_id and offset.

    Every document gets the id ``end`` at its end, so an empty or null text is one token. Rows that
    repeat an identifier are packed one by one, null identifiers included; an empty table gives no
    rows; other columns are ignored. A sequence shorter than ``length`` is to be padded to it.
    """
    width = encoder(tokenizer).dtype.itemsize
    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    pieces = rows.mapInArrow(
        _pieces(tokenizer, id, end, length),
        f"id {kind}, start bigint, ids binary, crc bigint, size bigint, total bigint",
    )
    # Written once, as the full pieces and the rests go separate ways; the numbers are part of the table,
    # so they stay the same when a task is run again.
    pieces = pieces.withColumn("number", F.monotonically_increasing_id())
    pieces = settle(pieces, scratch_path(docs.sparkSession))
    rests = pieces.where("ids IS NOT NULL")
    # At most one rest per document, so no group is larger than expected however long documents are.
    groups = max(1, -(-rests.count() // group_pieces))
    packed = (
        rests.withColumn("group", F.pmod(F.xxhash64("number", F.lit(SEED)), F.lit(groups)))
        .groupBy("group")
        .applyInArrow(
            _pack(length, width),
            f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
            "sequence_id bigint, offset bigint",
        )
    )
    full = pieces.where("ids IS NULL").select(
        "id",
        "start",
        F.col("size").alias("length"),
        F.col("crc").alias("ids_crc32"),
        F.col("total").alias("doc_tokens"),
        # Above the numbers of all groups.
        (F.col("number") + F.lit(groups * GROUP_SPAN)).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )
    packed = full.unionByName(packed)
    return packed.withColumnRenamed("id", id)
