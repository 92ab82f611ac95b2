"""Cheapest repair of the turn structure of conversations, by interval parsing.

The roles of a repaired conversation have initials ``(s?(ua)+)?``. That language has four states:
0 nothing yet, 1 after a system turn, 2 after a user turn, 3 after an assistant turn. The repair
grammar in Chomsky normal form has a nonterminal for each pair of states, "these rows, edited, lead
from p to r", with the rules (p, r) -> (p, q) (q, r). A cell holds, per nonterminal that derives the
span, the least (cost, audit). A span of one row is the insertion closure followed by one edit of
the row; longer spans are combined bottom-up by length.

Every rule only joins adjacent spans through a state, so joining is associative and each way to cut
a span gives the same cell. One cut per span is enough: spans are joined in pairs, lengths doubling,
which takes time in proportion to the rows where trying every cut would take their cube. Audits of
equal cost over equal rows are never beginnings of each other (the longer one would have more
insertions, which cost), so the ASCII-least choice within a span is right in any surroundings.

A conversation is split over tasks: rows are sorted in ranges, each task parses blocks of rows, and
only the blocks' cells meet per conversation. Solely the digest of the repaired text is made by one
task per conversation, reading its rows in order, because SHA-256 cannot be split.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.scratch import scratch_path, settle

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NAMES = {"u": "user", "a": "assistant"}
ENDS = (0, 3)
LEGAL = {"su", "ua", "au"}
BLOCK = 1024
AT_ONCE = 1024
# Per nonterminal (p, q) its least (cost, audit).
Cell = dict[tuple[int, int], tuple[int, str]]


def join(left: Cell, right: Cell) -> Cell:
    """The cell of two adjacent spans."""
    found: Cell = {}
    for (p, q), (cost, audit) in left.items():
        for (start, r), (more, rest) in right.items():
            if start == q:
                whole = (cost + more, audit + rest)
                if (p, r) not in found or whole < found[p, r]:
                    found[p, r] = whole
    return found


@functools.cache
def insertions() -> Cell:
    """The closure of inserting turns: the least way from each state to each other."""
    closure: Cell = {(p, p): (0, "") for p in range(4)}
    one = {(p, q): (INSERT, "I") for (p, role), q in STEPS.items() if role in NAMES}
    while True:
        wider = dict(closure)
        for pair, found in join(closure, one).items():
            wider[pair] = min(found, wider.get(pair, found))
        if wider == closure:
            return closure
        closure = wider


@functools.cache
def row_cell(kind: str) -> Cell:
    """The cell of one row. ``kind``: ``D`` for a row that must go; else its role's initial (``x``
    for one that no legal role has), in upper case if the row is truncated."""
    edits: Cell = {(p, p): (DELETE, "D") for p in range(4)}
    if kind != "D":
        extra = TRUNCATED if kind.isupper() else 0
        for (p, role), q in STEPS.items():
            ways = [(KEEP + extra, "K")] if role == kind.lower() else []
            ways += [(REROLE + extra, "R")] if role in NAMES else []
            for way in ways:
                edits[p, q] = min(way, edits.get((p, q), way))
    return join(insertions(), edits)


@functools.lru_cache(maxsize=1 << 16)
def _short(kinds: str) -> Cell:
    """Short spans are shared: few sequences of kinds make up most conversations."""
    if len(kinds) == 1:
        return row_cell(kinds)
    half = (len(kinds) + 1) // 2
    return join(_short(kinds[:half]), _short(kinds[half:]))


def parse(kinds: str) -> Cell:
    """The cell of a span of rows, combined bottom-up by span length."""
    spans = [_short(kinds[i : i + 8]) for i in range(0, len(kinds), 8)]
    while len(spans) > 1:
        spans = [join(*spans[i : i + 2]) if i + 1 < len(spans) else spans[i] for i in range(0, len(spans), 2)]
    return spans[0] if spans else {(p, p): (0, "") for p in range(4)}


def best(cell: Cell) -> tuple[int, str]:
    """The least (cost, audit) of a whole conversation."""
    whole = join(cell, insertions())
    return min(whole[0, end] for end in ENDS if (0, end) in whole)


class Spans:
    """Adjacent spans that arrive in order, joined so that lengths double."""

    def __init__(self) -> None:
        self.stack: list[tuple[int, Cell]] = []

    def add(self, cell: Cell) -> None:
        size = 1
        while self.stack and self.stack[-1][0] <= size:
            before, left = self.stack.pop()
            size, cell = size + before, join(left, cell)
        self.stack.append((size, cell))

    def cell(self) -> Cell:
        whole = self.stack[-1][1]
        for _, left in reversed(self.stack[:-1]):
            whole = join(left, whole)
        return whole


def damaged(turns: DataFrame) -> DataFrame:
    """The damage of the test query, by a checksum of ``conv_id:turn``; nulls count as one space."""
    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.pmod(F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn"))), F.lit(20))
    rows = turns.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
    return (
        rows.where("kind <> 0")
        .withColumn("text", text.otherwise(F.col("text")))
        .withColumn("role", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))))
        .select("conv_id", "turn", "role", "text")
    )


ORDER = ("conv", "timed", "turn", "role", "digest", "place")
_BLANKS = " \t\n\v\f\r"


def _rows(turns: DataFrame, conv: str, turn: str) -> DataFrame:
    """The turns with what orders them and their ``ending``, the last character that is no blank.

    Settled, so that all uses see the same places.
    """
    text = F.coalesce("text", F.lit(" "))
    rows = turns.select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").isNotNull().alias("timed"),
        F.col(f"`{turn}`").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        text.alias("text"),
        F.sha2(text, 256).alias("digest"),
        F.substring(F.rtrim(text, F.lit(_BLANKS)), -1, 1).alias("ending"),
        F.monotonically_increasing_id().alias("place"),
    )
    return settle(rows, scratch_path(turns.sparkSession))


def _kinds(rows: DataFrame) -> DataFrame:
    """The rows without their texts, with ``fault`` (0 to 3: none, blank, duplicate, truncated) and
    the ``kind`` that decides their cell.

    The first row of each content is found by a map-side aggregate and joined by place, so that no
    key is hot however often a content is repeated.
    """
    narrow = rows.drop("text")
    first = narrow.groupBy("conv", "role", "digest").agg(F.min(F.struct("timed", "turn", "place")).alias("head"))
    first = first.select(F.col("head.place").alias("place"), F.lit(True).alias("first"))
    fault = (
        F.when(F.col("ending") == "", 1)
        .when(F.col("first").isNull(), 2)
        .when(~F.col("ending").isin(".", "!", "?"), 3)
        .otherwise(0)
    )
    initial = F.substring("role", 1, 1)
    legal = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    kind = F.when(F.col("fault").isin(1, 2), "D").when(F.col("fault") == 3, F.upper(legal)).otherwise(legal)
    return narrow.join(first, "place", "left").withColumn("fault", fault).withColumns({"initial": initial, "kind": kind})


class _Block:
    """What is known of some adjacent rows of a conversation."""

    def __init__(self) -> None:
        self.faults = [0, 0, 0, 0]
        self.illegal, self.distinct = 0, 0
        self.first_initial, self.last_initial = None, None
        self.low, self.high = None, None  # the least and largest turn
        self.kinds: list[str] = []

    def row(self, turn: int | None, initial: str, fault: int, kind: str) -> None:
        if self.kinds:
            self.illegal += self.last_initial + initial not in LEGAL
        else:
            self.first_initial = initial
        self.last_initial = initial
        if turn is not None:
            self.distinct += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.faults[fault] += 1
        self.kinds.append(kind)

    def append(self, row: dict) -> None:
        """Add the block that follows, as it was written."""
        if self.last_initial is not None:
            self.illegal += self.last_initial + row["first_initial"] not in LEGAL
        self.last_initial = row["last_initial"]
        self.illegal += row["illegal"]
        self.distinct += row["distinct"] - (row["low"] is not None and row["low"] == self.high)
        self.low = row["low"] if self.low is None else self.low
        self.high = row["high"] if row["high"] is not None else self.high
        for fault in (1, 2, 3):
            self.faults[fault] += row[FAULTS[fault - 1]]

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.distinct


FAULTS = ("blank", "duplicate", "truncated")
_CELL = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())]))
_BLOCK = [
    ("part", pa.int64()), ("number", pa.int64()), *((f, pa.int64()) for f in FAULTS), ("illegal", pa.int64()),
    ("distinct", pa.int64()), ("first_initial", pa.string()), ("last_initial", pa.string()), ("low", pa.int64()),
    ("high", pa.int64()), ("cell", _CELL),
]
_FOUND = [("gaps", pa.int64()), *((f, pa.int64()) for f in FAULTS), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())]


def _batch(kind: pa.DataType, rows: list[tuple], fields: list[tuple]) -> pa.RecordBatch:
    schema = pa.schema([("conv", kind), *fields])
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _with_conv(kind: T.DataType, fields: str) -> T.StructType:
    return T.StructType([T.StructField("conv", kind), *T.StructType.fromDDL(fields).fields])


def _parse_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per block of at most ``BLOCK`` adjacent rows of a conversation."""
    part, number, current, block, out, kind = TaskContext.get().partitionId(), 0, None, None, [], pa.null()

    def close() -> None:
        nonlocal number
        cell = [
            {"start": p, "end": q, "cost": cost, "audit": audit}
            for (p, q), (cost, audit) in parse("".join(block.kinds)).items()
        ]
        out.append((
            current[0], part, number, *block.faults[1:], block.illegal, block.distinct,
            block.first_initial, block.last_initial, block.low, block.high, cell,
        ))
        number += 1

    for batch in batches:
        kind = batch.schema.field("conv").type
        for conv, turn, initial, fault, row_kind in zip(*(batch.column(c).to_pylist() for c in ("conv", "turn", "initial", "fault", "kind"))):
            if current != (conv,) or len(block.kinds) == BLOCK:
                if block is not None:
                    close()
                current, block = (conv,), _Block()
            block.row(turn, initial, fault, row_kind)
            if len(out) == AT_ONCE:
                yield _batch(kind, out, _BLOCK)
                out = []
    if block is not None:
        close()
        yield _batch(kind, out, _BLOCK)


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per conversation from its blocks, which follow each other in order."""
    current, whole, spans, out, kind = None, None, None, [], pa.null()

    def close() -> None:
        cost, audit = best(spans.cell())
        out.append((current[0], whole.gaps(), *whole.faults[1:], whole.illegal, cost, audit))

    for batch in batches:
        kind = batch.schema.field("conv").type
        for row in batch.to_pylist():
            if current != (row["conv"],):
                if current is not None:
                    close()
                current, whole, spans = (row["conv"],), _Block(), Spans()
            whole.append(row)
            spans.add({(c["start"], c["end"]): (c["cost"], c["audit"]) for c in row["cell"]})
            if len(out) == AT_ONCE:
                yield _batch(kind, out, _FOUND)
                out = []
    if current is not None:
        close()
        yield _batch(kind, out, _FOUND)


def repairs(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> tuple[DataFrame, DataFrame]:
    """The ordered turns, and per conversation (``conv``) its faults, ``cost`` and ``audit``."""
    spark = turns.sparkSession
    rows = _rows(turns, conv, turn)
    kind = rows.schema["conv"].dataType
    ordered = _kinds(rows).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    blocks = ordered.select("conv", "turn", "initial", "fault", "kind").mapInArrow(
        _parse_blocks,
        _with_conv(
            kind,
            "part bigint, number bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
            "distinct bigint, first_initial string, last_initial string, low bigint, high bigint, "
            "cell array<struct<start: bigint, end: bigint, cost: bigint, audit: string>>",
        ),
    )
    blocks = settle(blocks, scratch_path(spark))
    found = blocks.repartition("conv").sortWithinPartitions("conv", "part", "number").mapInArrow(
        _combine,
        _with_conv(
            kind,
            "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string",
        ),
    )
    return rows, settle(found, scratch_path(spark))


def edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired (role, text) rows. An audit leaves no choice of roles: they follow the states."""
    state = 0
    for step in audit:
        role, text = next(rows) if step != "I" else ("", "")
        if step == "D":
            continue
        if step != "K":
            role = NAMES["a" if state == 2 else "u"]
        state = STEPS[state, role[0]]
        yield role, text


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each repaired conversation; its audit comes before its rows, in order."""
    kind = pa.null()

    def stream() -> Iterator[tuple]:
        nonlocal kind
        for batch in batches:
            kind = batch.schema.field("conv").type
            yield from zip(*(batch.column(c).to_pylist() for c in ("conv", "is_row", "role", "text")))

    source, out = stream(), []
    for conv, _, _, audit in source:
        digest, first = hashlib.sha256(), True
        # The rows that the audit edits are the next ones of the stream.
        for role, text in edited(audit, ((role, text) for _, _, role, text in source)):
            digest.update((f"{role}:{text}" if first else f"\n{role}:{text}").encode())
            first = False
        out.append((conv, digest.hexdigest()))
        if len(out) == AT_ONCE:
            yield _batch(kind, out, [("repaired_sha256", pa.string())])
            out = []
    if out:
        yield _batch(kind, out, [("repaired_sha256", pa.string())])


def repair_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Per conversation its faults and its cheapest repair.

    Rows are in order of ``turn`` (null first; equal turns by role, then by a digest of the text). Null
    roles and texts count as one space. A row's first fault counts: ``blank`` (no character but ASCII
    white space), ``duplicate`` (role and text seen earlier), ``truncated`` (the last other character
    is none of ``.!?``). Edits cost: keep 0, rerole to user or assistant 2, delete 3 (required for
    blank and duplicate rows), insert an empty user or assistant turn 2; truncated rows that stay 1.
    ``audit`` has the edits' initials of the cheapest repair, of equally cheap ones the ASCII-least.
    A role whose initial is none of s, u, a, an empty one included, has to be reroled or deleted.
    ``illegal``: adjacent rows whose initials are none of su, ua, au; ``gaps``: turns missing between
    the least and the largest, null ones ignored. ``repaired_sha256``: of ``role:text`` lines. Rows
    with a null identifier are one conversation; identical rows may stand in either order; an empty table gives
    no rows; other columns are ignored.
    """
    rows, found = repairs(turns, conv, turn)
    kind = rows.schema["conv"].dataType
    order = ["conv", "is_row", *ORDER[1:]]
    audits = found.select("conv", F.lit(False).alias("is_row"), F.lit("").alias("role"), F.col("audit").alias("text"))
    both = rows.withColumn("is_row", F.lit(True)).unionByName(audits, allowMissingColumns=True)
    digests = (
        both.repartition("conv")
        .sortWithinPartitions(*order)
        .select("conv", "is_row", "role", "text")
        .mapInArrow(_digest, _with_conv(kind, "repaired_sha256 string"))
    )
    joined = found.join(digests.withColumnRenamed("conv", "again"), F.col("conv").eqNullSafe(F.col("again")))
    return joined.drop("again").withColumnRenamed("conv", conv)


def with_absent(repaired: DataFrame, turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Also the conversations of ``turns`` that have no row left: zeros and the empty repair."""
    every = turns.select(F.col(f"`{conv}`").alias("every")).distinct()
    joined = every.join(repaired, F.col("every").eqNullSafe(F.col(f"`{conv}`")), "left").drop(conv)
    empty = {c: 0 for c in ("gaps", *FAULTS, "illegal", "cost")} | {
        "audit": "", "repaired_sha256": hashlib.sha256().hexdigest()
    }
    filled = joined.withColumns({c: F.coalesce(c, F.lit(v).cast(joined.schema[c].dataType)) for c, v in empty.items()})
    return filled.withColumnRenamed("every", conv)
