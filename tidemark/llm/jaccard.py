"""Documents joined by the Jaccard similarity of their word shingles, through token groups.

Similar sets are put into groups; a group is known by the union of its members' tokens (the
token-group matrix). A query set asks with its tokens: the number of them inside the union bounds its
overlap with every member, so only groups that can hold a partner are opened and compared member by
member. Equal sets count once, under the hash of their tokens.

1. *Order.* Tokens found in several sets of a batch are counted over the corpus. The frequent ones
   come last in the order of tokens, all others in the order of their hashes.
2. *Prefixes.* Two sets of sizes x >= y with similarity t share at least o = t/(1+t) (x+y) tokens, so
   they share one of the first x-o+1 and y-o+1 tokens. Only these prefixes are shuffled, and of them
   only tokens that two sets have go on.
3. *Groups.* For each shared token the set that has the fewest rarer tokens is the leader: the least
   altered one of a family of copies. Sets are compared with a few leaders; verified links make
   components. Each set joins the group of one leader: its core if they are linked, its rest if not.
   So a family of copies is two groups, however many of its members are too far apart for a link.
4. *Matrix.* (token, group) rows over the prefixes, with sizes, places and components, are joined with
   the prefixes of all sets. Bounds leave the (set, group) pairs that may hold a link to another
   component.
5. *Opening.* The pairs' groups are split into chunks of bounded size and the sets that ask into
   blocks. A task holds one chunk with the union of its tokens, streams the sets past it, and opens it
   for those whose overlap with the union suffices. A set is linked with one member of each component
   that the task has not connected with its own yet.

No step lists the pairs within a group, yet every link between different groups is found, so the
components are those of all links. Nothing is sampled, and there is no limit on partners.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.components import components
from tidemark.llm.shared import pack
from tidemark.sources.scratch import scratch_path, settle

SHINGLE = 5
PERCENT = 80
AT_ONCE = 1 << 21  # tokens
SHARE = 1 << 18  # tokens of a chunk, or of a block of queries
PICKS = 2
FREQUENT = 16
MOST_FREQUENT = 1 << 18
BITMAP = 1 << 26
BUCKET = 1 << 15
REMEMBERED = 1 << 20
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class CollisionError(ValueError):
    """Two different token sets have one hash; another ``seed`` tells them apart."""


def tokens(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted hashes of the distinct shingles of a whole text; with fewer words, of all of them."""
    split = text.lower().split()
    if not split:
        return np.empty(0, np.uint64)
    if len(split) < shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(split), len(split))], np.uint64)
    codes = np.fromiter(map(xxhash.xxh64_intdigest, split), np.uint64, len(split))
    mixed = codes[: len(codes) - shingle + 1].copy()
    for i in range(1, shingle):
        mixed = mixed * MULTIPLIER + codes[i : len(codes) - shingle + 1 + i]
    # The words' hashes are spread once more, so that the order of shingles does not follow them.
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    mixed.sort()
    return mixed[np.concatenate([[True], mixed[1:] != mixed[:-1]])]


def needed(total: int | np.ndarray, percent: int) -> int | np.ndarray:
    """The least intersection of two linked sets of ``total`` tokens together."""
    return -(-percent * total // (100 + percent))


def probe_length(n: np.ndarray, percent: int) -> np.ndarray:
    """First tokens of which a linked set of at most ``n`` tokens has one among its own first ones."""
    return n - -(-percent * n // 100) + 1


class _Read:
    """Texts of a task as token sets, some million tokens at a time."""

    def __init__(self, shingle: int, seed: int) -> None:
        self.shingle, self.seed = shingle, seed
        self.clear()

    def clear(self) -> None:
        self.ids, self.sets, self.keys, self.raws, self.held = [], [], [], [], 0

    def raw(self, text: bytes) -> int:
        """A hash of the text as it is, which is cheaper than that of its set."""
        return xxhash.xxh64_intdigest(text, self.seed + 2)

    def add(self, id, text: bytes, raw: int) -> bool:
        """Whether enough is held for the caller to go on with it."""
        found = tokens(text, self.shingle)
        self.ids.append(id)
        self.sets.append(found)
        self.keys.append(xxhash.xxh64_intdigest(found.tobytes(), self.seed))
        self.raws.append(raw)
        self.held += len(found) + 1
        return self.held >= AT_ONCE


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Scalar, bytes]]:
    for batch in batches:
        for id, text in zip(batch.column("id"), batch.column("text").cast(pa.binary())):
            yield id, text.as_py() or b""


def _new_texts(batches: Iterator[pa.RecordBatch], reader: _Read) -> Iterator[tuple[bytes, int]]:
    """Texts that the task has not had yet (or not for very many texts), with their hashes."""
    seen: set[int] = set()
    for _, text in _texts(batches):
        raw = reader.raw(text)
        if raw not in seen:
            if len(seen) > REMEMBERED:
                seen.clear()
            seen.add(raw)
            yield text, raw


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


SUMMARY = ("is_document", "id", "n", "key", "check", "raw")


def _summaries(kind: pa.DataType, shingle: int, seed: int):
    """A row per document, and one per token that several of the sets at hand have."""

    def both(reader: _Read) -> Iterator[pa.RecordBatch]:
        checks = [xxhash.xxh64_intdigest(s.tobytes(), seed + 1) for s in reader.sets]
        sizes = pa.array([len(s) for s in reader.sets], pa.int64())
        hashes = [pa.array(_signed(h)) for h in (reader.keys, checks, reader.raws)]
        flags = pa.array([True] * len(checks), pa.bool_())
        yield pa.RecordBatch.from_arrays([flags, pa.array(reader.ids, kind), sizes, *hashes], list(SUMMARY))
        flat = np.sort(np.concatenate(list(dict(zip(reader.keys, reader.sets)).values())))
        starts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.empty(0, int)
        n = np.diff(np.append(starts, len(flat)))
        found, n = flat[starts][n > 1], n[n > 1]
        flags, nothing = pa.array([False] * len(n), pa.bool_()), pa.nulls(len(n), pa.int64())
        columns = [flags, pa.nulls(len(n), kind), pa.array(n), pa.array(found.view(np.int64)), nothing, nothing]
        yield pa.RecordBatch.from_arrays(columns, list(SUMMARY))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Read(shingle, seed)
        for id, text in _texts(batches):
            if reader.add(id.as_py(), text, reader.raw(text)):
                yield from both(reader)
                reader.clear()
        if reader.ids:
            yield from both(reader)

    return run


def frequent_tokens(counts: DataFrame) -> np.ndarray:
    """The most frequent tokens, sorted: at most ``MOST_FREQUENT``, since each has that share of all
    counted ones. They only decide the order of tokens; every order gives the same links."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = max(FREQUENT, total // MOST_FREQUENT + 1)
    rows = counts.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("key").collect()
    return np.sort(np.array([r["key"] for r in rows], np.int64).view(np.uint64))


def _prefixes(frequent: np.ndarray, shingle: int, seed: int, percent: int):
    """The first tokens of each set: token, set, ``salt`` (above zero for frequent tokens), size and
    number of tokens before it."""

    def first_tokens(reader: _Read) -> pa.RecordBatch:
        distinct = dict(zip(reader.keys, reader.sets))
        sets, keys = list(distinct.values()), _signed(list(distinct))
        flat = np.concatenate(sets)
        n = np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(len(sets)), n)
        late = np.zeros(len(flat), bool)
        if len(frequent):
            late = frequent[np.minimum(np.searchsorted(frequent, flat), len(frequent) - 1)] == flat
        # Sorted by hash within a set already, so a stable sort by two classes is enough.
        order = np.argsort(2 * owner + late, kind="stable")
        flat, late = flat[order], late[order]
        place = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
        first = place < probe_length(n, percent)[owner]
        owner, late = owner[first], late[first]
        key = keys[owner]
        salt = np.where(late, 1 + (key & 0xFFFF), 0).astype(np.int32)
        columns = [flat[first].view(np.int64), key, salt, n[owner].astype(np.int32), place[first].astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "key", "salt", "n", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Read(shingle, seed)
        for text, raw in _new_texts(batches, reader):
            if reader.add(None, text, raw):
                yield first_tokens(reader)
                reader.clear()
        if reader.sets:
            yield first_tokens(reader)

    return run


def shared_prefixes(texts: DataFrame, frequent: np.ndarray, shingle: int, seed: int, percent: int) -> DataFrame:
    """The prefixes' tokens that several sets have; a frequent one, salted by its set, always counts."""
    rows = texts.mapInArrow(_prefixes(frequent, shingle, seed, percent), "token bigint, key bigint, salt int, n int, place int")
    together = Window.partitionBy("token", "salt")
    several = F.min("key").over(together) < F.max("key").over(together)
    rows = rows.withColumn("several", several).where((F.col("salt") > 0) | F.col("several")).drop("several")
    return settle(rows.dropDuplicates(["token", "salt", "key"]), scratch_path(texts.sparkSession))


def refuse_collisions(keys: DataFrame, seed: int) -> None:
    """``low`` and ``high``: the range of second hashes under one ``key``."""
    if keys.where("low <> high").limit(1).count():
        raise CollisionError(f"two token sets share a hash under seed {seed}")


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """Bits of the column ``raw`` modulo ``BITMAP``: 8 MB, whatever the number of hashes."""
    place = F.pmod("raw", F.lit(BITMAP))
    rows = hashes.groupBy(F.shiftright(place, 15).cast("int").alias("bucket")).agg(
        F.bitmap_construct_agg(place.bitwiseAND(F.lit(BUCKET - 1))).alias("bits")
    )
    found = np.zeros(BITMAP // 8, np.uint8)
    for row in rows.collect():
        start = row["bucket"] * BUCKET // 8
        found[start : start + BUCKET // 8] = np.frombuffer(row["bits"], np.uint8)
    return found


def _chosen(bitmap: np.ndarray, shingle: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for text, raw in _new_texts(batches, _Read(shingle, seed)):
            place = raw % BITMAP
            if bitmap[place >> 3] >> (place & 7) & 1:
                out.append((raw, text))
                held += len(text)
            if held >= AT_ONCE:
                yield _texts_batch(out)
                out, held = [], 0
        if out:
            yield _texts_batch(out)

    return run


def _texts_batch(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    raws, texts = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(_signed(list(raws))), pa.array(texts, pa.binary())], ["raw", "text"])


def chosen_texts(texts: DataFrame, wanted: DataFrame, shingle: int, seed: int) -> DataFrame:
    """``raw`` and ``text`` of the texts whose hash ``wanted`` has; others may be among them.

    The bitmap of the hashes is all that is broadcast. Texts are smaller than their sets, so they are
    what travels, and sets are made where they are compared.
    """
    rows = texts.mapInArrow(_chosen(_bitmap(wanted), shingle, seed), "raw bigint, text binary")
    return rows.dropDuplicates(["raw"])


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All places from each ``low`` up to its ``high``, one after the other."""
    n = high - low
    return np.arange(n.sum()) + np.repeat(low - np.cumsum(n) + n, n)


class Chunk:
    """Some members of a group: the union of their tokens, and which member has which."""

    def __init__(self, keys: list[int], sets: list[np.ndarray]) -> None:
        self.keys, self.sizes = keys, np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        self.flat, self.owner = flat[order], np.repeat(np.arange(len(sets)), self.sizes)[order]

    def linked(self, query: np.ndarray, percent: int) -> np.ndarray:
        """Places of the members linked with ``query``."""
        low, high = np.searchsorted(self.flat, query), np.searchsorted(self.flat, query, "right")
        bound = int((high > low).sum())
        if 100 * bound < percent * len(query):
            return np.empty(0, np.int64)  # not even the union has enough of the query's tokens
        overlap = np.bincount(self.owner[_ranges(low, high)], minlength=len(self.keys))
        return np.flatnonzero(overlap >= needed(self.sizes + len(query), percent))


class Connected:
    """Components that the links of a task have connected."""

    def __init__(self) -> None:
        self.root: dict[int, int] = {}

    def top(self, component: int) -> int:
        while (above := self.root.get(component, component)) != component:
            component = above
        return component

    def join(self, one: int, other: int) -> bool:
        """Connect two components; whether they were apart."""
        one, other = self.top(one), self.top(other)
        self.root[one] = other
        return one != other


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_OPENED = ("group", "core", "chunk", "block", "asks", "key", "component")


def _open(shingle: int, percent: int):
    """Links of the queries that follow each chunk's members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, keys, sets, homes, chunk, connected = None, [], [], [], None, None
        for batch in batches:
            out = []
            places = zip(*(batch.column(c).to_pylist() for c in _OPENED))
            for (*place, asks, key, component), text in zip(places, batch.column("text")):
                if place != current:
                    current, keys, sets, homes, chunk, connected = place, [], [], [], None, Connected()
                found = tokens(text.as_py(), shingle)
                if not asks:
                    keys.append(key)
                    sets.append(found)
                    homes.append(component)
                    continue
                if not keys:
                    continue  # the group's members were all dealt to its other chunks
                if chunk is None:
                    chunk = Chunk(keys, sets)
                for i in chunk.linked(found, percent).tolist():
                    if connected.join(component, homes[i]):
                        out.append((key, keys[i]))
            yield pack(out, _LINKS)

    return run


def open_groups(
    asking: DataFrame, members: DataFrame, raws: DataFrame, texts: DataFrame, shingle: int, percent: int
) -> DataFrame:
    """Links ``a``, ``b`` of sets with members of groups, as many as connect their components.

    ``asking`` and ``members`` have ``group`` and ``core``, which name the group, ``key``, ``n`` and
    ``component``; ``raws`` has the hash ``raw`` of a text of each ``key``, ``texts`` the texts. A group with many members or queries is dealt to several tasks: each task reads
    about ``SHARE`` tokens of members, and each query goes to every chunk of its group.
    """
    named = ["group", "core"]

    def parts(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy(*named).agg(F.ceil(F.sum("n") / SHARE).alias(name))

    def dealt(name: str) -> Column:
        return F.pmod(F.xxhash64("key"), F.col(name))

    def each(name: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(name) - 1))

    asked = parts(asking, "blocks")
    plan = settle(parts(members, "chunks").join(asked, named), scratch_path(texts.sparkSession))
    held = members.join(plan, named).withColumn("chunk", dealt("chunks")).withColumn("block", each("blocks"))
    queries = asking.join(plan, named).withColumn("block", dealt("blocks")).withColumn("chunk", each("chunks"))
    held = held.withColumn("asks", F.lit(False)).select(*_OPENED)
    rows = held.unionByName(queries.withColumn("asks", F.lit(True)).select(*_OPENED))
    rows = rows.join(raws, "key").join(texts, "raw").select(*_OPENED, "text")
    rows = rows.repartition(*_OPENED[:4]).sortWithinPartitions(*_OPENED[:5])
    return rows.mapInArrow(_open(shingle, percent), "a bigint, b bigint")


def least_overlap(total: Column, percent: int) -> Column:
    """``needed`` as an expression."""
    return F.ceil(percent * total / (100 + percent))


def leader_pairs(shared: DataFrame, percent: int) -> DataFrame:
    """``key`` and ``n`` of sets with ``leader`` and ``leader_n`` of the leaders of their first few
    ordinary and frequent tokens, as far as sizes and places allow a link, and the ``hits`` of each."""
    first = F.row_number().over(Window.partitionBy("key", F.col("salt") > 0).orderBy("place"))
    mine = shared.withColumn("first", first).where(F.col("first") <= PICKS).select("token", "key", "n", "place")
    least = F.min(F.struct("place", "key", "n")).alias("least")
    leaders = shared.groupBy("token").agg(least).select(
        "token",
        F.col("least.key").alias("leader"),
        F.col("least.n").alias("leader_n"),
        F.col("least.place").alias("leader_place"),
    )
    # At most the tokens before the common one, it, and the tokens after it are in both sets.
    before = F.least("place", "leader_place")
    after = F.least(F.col("n") - F.col("place"), F.col("leader_n") - F.col("leader_place"))
    possible = before + after >= least_overlap(F.col("n") + F.col("leader_n"), percent)
    pairs = mine.join(leaders, "token").where((F.col("key") != F.col("leader")) & possible)
    return pairs.groupBy("leader", "key", "n", "leader_n").agg(F.count(F.lit(1)).alias("hits"))


def candidates(shared: DataFrame, percent: int) -> DataFrame:
    """The sets that may be linked with a member of a group that is in another component.

    ``shared`` has the group and component of each set, as :func:`grouped` gives them. A set asks for
    partners that are not larger than itself. A row of the matrix knows the least and largest size of
    the group's members that have the token among their first ones, the earliest place of it, and the
    range of their components.

    A set first meets a group by a token that may be the first one it has in common with a member.
    Then all tokens of its prefix inside the union of the members' prefixes are counted: of the tokens
    that it shares with a member, those in both prefixes are among them, and fewer than ``percent`` of
    its size are not. A link needs more than that from all but the smallest partners.
    """
    n, place = F.col("n"), F.col("place")
    share = F.ceil(percent * n / 100)
    indexed = place <= n - least_overlap(2 * n, percent)
    matrix = shared.groupBy("token", F.col("group").alias("other"), F.col("core").alias("other_core")).agg(
        F.min("n").alias("low"),
        F.max("n").alias("high"),
        F.min(F.when(indexed, place)).alias("early"),
        F.min("component").alias("low_component"),
        F.max("component").alias("high_component"),
        F.min("key").alias("low_key"),
        F.max("key").alias("high_key"),
    )
    matrix = settle(matrix, scratch_path(shared.sparkSession))
    connected = (F.col("low_component") == F.col("component")) & (F.col("high_component") == F.col("component"))
    # A set has been compared with its leader, and a leader with all of its group.
    leader_only = (F.col("low_key") == F.col("group")) & (F.col("high_key") == F.col("group"))
    compared = leader_only | (F.col("other") == F.col("key"))
    near = ~(connected | compared) & (F.col("low") <= n) & (F.col("high") >= share)
    smallest = F.greatest(F.col("low"), share)
    overlap = least_overlap(n + smallest, percent)
    first = (n - place >= overlap) & (F.least(F.col("high"), n) - F.col("early") >= overlap)
    met = shared.join(matrix.where("early IS NOT NULL"), "token").where(near & first)
    met = settle(met.select("other", "other_core", "key").distinct(), scratch_path(shared.sparkSession))
    alone = shared.groupBy("group", "core").agg(F.min("key").alias("member"), F.max("key").alias("last"))
    alone = alone.where("member = last").select(
        F.col("group").alias("other"), F.col("core").alias("other_core"), "member"
    )
    alone = settle(alone, scratch_path(shared.sparkSession))
    named = ["other", "other_core"]
    counted = (
        met.join(alone, named, "left_anti")
        .join(shared, "key")
        .join(matrix, ["token", *named])
        .where(near)
        .groupBy(*named, "key", "n", "component")
        .agg(F.count(F.lit(1)).alias("common"), F.min(smallest).alias("smallest"))
    )
    # A group of one set is known by that set's tokens, so the two sets meet in one row.
    sets = shared.groupBy("key", "n", "component").agg(F.collect_set("token").alias("tokens"))
    sets = settle(sets, scratch_path(shared.sparkSession))
    members = sets.select(F.col("key").alias("member"), F.col("n").alias("low"), F.col("tokens").alias("others"))
    pairs = met.join(alone, named).join(sets, "key").join(members, "member").select(
        *named, "key", "n", "component",
        F.size(F.array_intersect("tokens", "others")).alias("common"),
        smallest.alias("smallest"),
    )
    enough = F.col("common") > least_overlap(n + F.col("smallest"), percent) - share
    return counted.unionByName(pairs).where(enough).select(
        F.col("other").alias("group"), F.col("other_core").alias("core"), "key", "n", "component"
    )


def grouped(sizes: DataFrame, pairs: DataFrame, links: DataFrame) -> DataFrame:
    """``key`` and ``n`` of all sets with their ``component`` so far, and their group: the leader that
    they are linked with, or else the one they met most often, or else themselves; ``core`` says
    whether they are linked with it."""
    linked = links.select(F.col("a").alias("key"), F.col("b").alias("leader"), F.lit(True).alias("core"))
    met = pairs.join(linked, ["key", "leader"], "left").withColumn("core", F.coalesce("core", F.lit(False)))
    chosen = met.groupBy("key").agg(F.max(F.struct("core", "hits", "leader")).alias("chosen"))
    roots = components(links).withColumnRenamed("node", "key")
    return sizes.join(chosen, "key", "left").join(roots, "key", "left").select(
        "key",
        "n",
        F.coalesce("chosen.leader", "key").alias("group"),
        F.coalesce("chosen.core", F.lit(True)).alias("core"),
        F.coalesce("root", "key").alias("component"),
    )


def jaccard_components(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    seed: int = 0,
) -> DataFrame:
    """``id``, ``n_shingles`` and ``component_id``, the smallest identifier reached over links.

    Texts are lower-cased (A-Z) and cut at ASCII white space; the set of a text is its distinct
    shingles, or all its words as one where there are fewer. Two sets are linked when their
    intersection is at least ``percent`` of their union. Texts without words, null ones among them,
    have no shingles and are their own component. One row per row of ``docs``: equal rows are linked
    like any others, and null identifiers only name a component that has no other. An empty table
    gives no rows; other columns are ignored. Shingles are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    kind = texts.schema["id"].dataType
    schema = T.StructType([T.StructField("is_document", T.BooleanType()), T.StructField("id", kind)])
    for name in SUMMARY[2:]:
        schema = schema.add(name, T.LongType())
    summaries = settle(texts.mapInArrow(_summaries(to_arrow_type(kind), shingle, seed), schema), scratch_path(spark))
    rows = summaries.where("is_document").drop("is_document")
    frequent = frequent_tokens(summaries.where("NOT is_document").select("key", "n"))
    worded = rows.where("n > 0")
    keys = worded.groupBy("key").agg(
        F.min("id").alias("own"), F.min("check").alias("low"), F.max("check").alias("high"), F.min("raw").alias("raw")
    )
    keys = settle(keys, scratch_path(spark))
    refuse_collisions(keys, seed)

    def opened(asking: DataFrame, members: DataFrame) -> DataFrame:
        used = members.join(asking, ["group", "core"], "left_semi").select("key").unionByName(asking.select("key"))
        raws = settle(keys.join(used.distinct(), "key", "left_semi").select("key", "raw"), scratch_path(spark))
        found = chosen_texts(texts, raws, shingle, seed)
        return settle(open_groups(asking, members, raws, found, shingle, percent), scratch_path(spark))

    shared = shared_prefixes(texts, frequent, shingle, seed, percent)
    sizes = settle(shared.select("key", "n").distinct(), scratch_path(spark))
    pairs = settle(leader_pairs(shared, percent), scratch_path(spark))
    # Each leader is a group of its own at first, and each set a component of its own.
    asking = pairs.select(F.col("leader").alias("group"), F.lit(True).alias("core"), "key", "n", F.col("key").alias("component"))
    leaders = pairs.select(F.col("leader").alias("key"), F.col("leader_n").alias("n")).distinct()
    leaders = leaders.select(F.col("key").alias("group"), F.lit(True).alias("core"), "key", "n", F.col("key").alias("component"))
    links = opened(asking, leaders)
    members = settle(grouped(sizes, pairs, links), scratch_path(spark))
    placed = settle(shared.join(members.drop("n"), "key"), scratch_path(spark))
    asking = settle(candidates(placed, percent), scratch_path(spark))
    links = links.unionByName(opened(asking, members))

    rooted = keys.join(components(links).withColumnRenamed("node", "key"), "key", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "key"))
    least = rooted.groupBy("root").agg(F.min("own").alias("component"))
    named = settle(rooted.join(least, "root").select("key", "component"), scratch_path(spark))
    linked = worded.join(named, "key").select("id", "n", "component")
    alone = rows.where("n = 0").select("id", "n", F.col("id").alias("component"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id), F.col("n").alias("n_shingles"), F.col("component").alias("component_id")
    )
