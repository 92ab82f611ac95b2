"""Chat formatting on tokens.

Every turn is a sequence of segments: a reserved id that opens it, the ids of the role, a reserved
id, the ids of the text, and a reserved id that closes it. Role and text are encoded separately, so
no token spans two segments and no text can produce a reserved id. As the reserved ids are shown as
control strings when a sequence is printed, such strings are escaped in roles and texts by a
backslash, and backslashes by doubling. A segment's place, and with it the loss mask, follows from
the prefix sum of the segment lengths. Turns stay rows: a conversation of any length is never
gathered.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidemark.llm.bpe import ALPHABET
from tidemark.llm.shared import unpack
from tidemark.sources.scratch import scratch_path, settle

# Control strings of the reserved ids: they open a turn, end its role, and close it.
OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
# Strings that get a backslash inside roles and texts, so that no printed text looks like a turn.
# In a longer run of "#" an opener begins at several places, so each "#" of such runs gets one.
CONTROL = re.compile(r"\\|#{3,}|</turn>|: ")
TRAINED = "assistant"
ROLES_KEPT = 1 << 12
AT_ONCE = 64  # texts a call of the library


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: "\\#" * len(m[0]) if m[0][0] == "#" else "\\" + m[0], text)


def unescape(text: str) -> str:
    """The inverse of :func:`escape`: a backslash only ever stands before what it escapes."""
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


class Coder:
    """Byte-level ids of strings and back, with three reserved ids after the vocabulary."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.roles: dict[str, list[int]] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = True
        back = {letter: byte for byte, letter in ALPHABET.items()}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        size = max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        self.bytes = [b""] * size
        for token, number in vocabulary.items():
            if all(c in back for c in token):
                self.bytes[number] = bytes(back[c] for c in token)
        self.open, self.middle, self.close = range(size, size + 3)
        self.bytes += [s.encode() for s in (OPEN, MIDDLE, CLOSE)]
        self.dtype = np.dtype("<u2" if size + 3 <= 1 << 16 else "<u4")

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text, by one call of the library."""
        escaped = [escape(t) for t in texts]
        return [e.ids for e in self.tokenizer.encode_batch_fast(escaped, add_special_tokens=False)]

    def role(self, role: str) -> list[int]:
        """The ids of a role, kept for a bounded number of roles."""
        if role not in self.roles:
            if len(self.roles) >= ROLES_KEPT:
                self.roles.clear()
            self.roles[role] = self.encode(role)
        return self.roles[role]

    def print(self, ids: list[int]) -> str:
        """As it looks: text with control strings."""
        return b"".join(map(self.bytes.__getitem__, ids)).decode()

    def turn(self, role: str, text: str) -> tuple[list[int], int, int]:
        """The ids of a turn, and the bounds of its text within them."""
        return self.assemble(role, self.encode(text))

    def assemble(self, role: str, body: list[int]) -> tuple[list[int], int, int]:
        head = [self.open, *self.role(role), self.middle]
        return [*head, *body, self.close], len(head), len(head) + len(body)

    def parse(self, ids: list[int]) -> tuple[str, str]:
        """Role and text of the ids of a turn."""
        middle = ids.index(self.middle)
        if ids[0] != self.open or ids[-1] != self.close:
            raise ValueError("not a turn")
        return unescape(self.print(ids[1:middle])), unescape(self.print(ids[middle + 1 : -1]))


@functools.lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    """One per worker process and tokenizer file."""
    return Coder(path)


def _segments(tokenizer: str, trained: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(tokenizer)
        for batch in batches:
            out = []
            roles, texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
            for first in range(0, len(texts), AT_ONCE):
                bodies = code.encode_all([t or "" for t in texts[first : first + AT_ONCE]])
                for role, body in zip(roles[first:], bodies):
                    ids, start, end = code.assemble(role or "", body)
                    lost = (start, end) if role == trained else (0, 0)
                    out.append((np.array(ids, code.dtype).tobytes(), len(ids), *lost))
            columns = zip(*out) if out else [[]] * 4
            types = [pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("turn"), *(pa.array(c, t) for c, t in zip(columns, types))],
                ["conv", "turn", "ids", "n_ids", "loss_from", "loss_to"],
            )

    return run


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``place`` and ``start`` of each row within its conversation's rows in this partition."""
    part, current, place, start = TaskContext.get().partitionId(), None, 0, 0
    for batch in batches:
        places, starts = [], []
        for conv, n in zip(batch.column("conv").to_pylist(), batch.column("n_ids").to_pylist()):
            if current != (conv,):
                current, place, start = (conv,), 0, 0
            places.append(place)
            starts.append(start)
            place, start = place + 1, start + n
        added = {"part": pa.array([part] * len(places), pa.int64()), "place": pa.array(places, pa.int64()), "start": pa.array(starts, pa.int64())}
        yield pa.RecordBatch.from_arrays([*batch.columns, *added.values()], [*batch.schema.names, *added])


def _numbered(cut: DataFrame) -> DataFrame:
    """The encoded turns with their ``place`` and ``start`` in the whole conversation.

    Rows are sorted in ranges, so a long conversation lies in several partitions. Each one counts from
    zero; what its conversation has in earlier partitions is added afterwards. At most one conversation
    goes on from one partition to the next, so there are fewer such totals than partitions.
    """
    spark = cut.sparkSession
    order = ("conv", "timed", "turn", "ids")
    ranged = cut.withColumn("timed", F.col("turn").isNotNull()).repartitionByRange(*order)
    rows = ranged.sortWithinPartitions(*order).drop("timed", "turn")
    schema = T.StructType([*rows.schema.fields, *(T.StructField(c, T.LongType()) for c in ("part", "place", "start"))])
    rows = settle(rows.mapInArrow(_running, schema), scratch_path(spark))
    totals = rows.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("rows"), F.sum("n_ids").alias("ids"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        F.col("conv").alias("whose"),
        F.col("part").alias("where"),
        F.sum("rows").over(earlier).alias("rows_before"),
        F.sum("ids").over(earlier).alias("ids_before"),
    ).where(F.col("rows_before").isNotNull())
    same = F.col("conv").eqNullSafe(F.col("whose")) & (F.col("part") == F.col("where"))
    joined = rows.join(F.broadcast(settle(totals, scratch_path(spark))), same, "left")
    return joined.withColumns({
        "place": F.col("place") + F.coalesce("rows_before", F.lit(0)),
        "start": F.col("start") + F.coalesce("ids_before", F.lit(0)),
    })


def format_chats(
    turns: DataFrame, tokenizer: str, conv: str = "conv_id", turn: str = "turn", trained: str = TRAINED
) -> DataFrame:
    """One row per turn of the formatted conversations.

    Columns: ``conv``, ``place`` (turns before it), ``ids`` (unsigned integers), ``start`` (ids of the
    conversation before it), ``n_ids``, and ``loss_from`` to ``loss_to``, the part of the
    conversation's ids under the loss mask (empty for turns that are not trained on). Turns are in
    order of ``turn``, then of their ids; null turns come first. Null texts and roles are
    empty, and rows without a conversation's identifier are one conversation. An empty table gives
    no rows; other columns are ignored.
    """
    code = coder(tokenizer)
    rows = turns.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), F.col("role"), F.col("text")
    )
    schema = T.StructType([rows.schema["conv"], rows.schema["turn"], T.StructField("ids", T.BinaryType())])
    for name in ("n_ids", "loss_from", "loss_to"):
        schema = schema.add(name, T.LongType())
    cut = settle(rows.mapInArrow(_segments(tokenizer, trained), schema), scratch_path(turns.sparkSession))
    return _numbered(cut).select(
        "conv",
        "place",
        "ids",
        "start",
        "n_ids",
        (F.col("start") + F.col("loss_from")).alias("loss_from"),
        (F.col("start") + F.col("loss_to")).alias("loss_to"),
        F.lit(code.dtype.itemsize).alias("width"),
    )


def _digest(tokenizer: str):
    """Digests of conversations whose rows follow each other in order, turn by turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(tokenizer)
        current, state, out, kind = None, None, [], pa.null()

        def close():
            n, turns, chars, loss, length = state
            out.append((current[0], n, turns.hexdigest(), chars, loss.hexdigest(), length))

        for batch in batches:
            kind = batch.schema.field("conv").type
            for conv, ids, start, low, high in unpack(batch):
                if current != (conv,):
                    if current is not None:
                        close()
                    current, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids = np.frombuffer(ids, code.dtype).tolist()
                role, text = code.parse(ids)
                trained = unescape(code.print(ids[low - start : high - start]))
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(trained)
                state[3].update(trained.encode())
                state[4] += len(code.print(ids))
            yield _conversations(kind, out)
            out = []
        if current is not None:
            close()
            yield _conversations(kind, out)

    return run


def _conversations(kind: pa.DataType, rows: list[tuple]) -> pa.RecordBatch:
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def digests(formatted: DataFrame, tokenizer: str, conv: str = "conv_id") -> DataFrame:
    """What the formatted rows of :func:`format_chats` hold, per conversation.

    A long conversation is read turn by turn with two running digests.
    """
    kind = formatted.schema["conv"].dataType.simpleString()
    rows = formatted.repartition("conv").sortWithinPartitions("conv", "place")
    found = rows.select("conv", "ids", "start", "loss_from", "loss_to").mapInArrow(
        _digest(tokenizer),
        f"conv {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )
    return found.withColumnRenamed("conv", conv)
