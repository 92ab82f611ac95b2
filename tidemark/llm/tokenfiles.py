"""Token-id files: documents compressed one by one with a shared zstandard dictionary.

The dictionary is trained on the serialized ids of a bounded sample of documents: at most
``SAMPLE_ROWS`` rows, chosen by the hash of their identifiers, of which at most ``SAMPLE_BYTES`` each
are used, in slices evenly spaced from beginning to end. It only affects sizes. A file is

    magic, 8 bytes | SHA-256 of the dictionary, 32 | bytes per id, 1
    one zstandard frame per document
    index: an Arrow IPC file with id, offset, size, n_tokens per document
    length of the index, 8 | magic, 8

all little-endian, in ascending order of identifiers; files are numbered in that order, too. A
document is read with two reads of a few bytes: its place from the index, and its frame.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow.fs import FileSelector
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import file_system, open_new, open_old, spread
from tidemark.llm.tokens import encoder
from tidemark.sources.scratch import settle

MAGIC = b"TIDEIDS1"
HEAD = "<8s32sB"
TAIL = "<Q8s"
SAMPLE_ROWS = 512
SAMPLE_BYTES = 1 << 15
SLICES = 16
DICTIONARY_BYTES = 1 << 16
LEAST_SAMPLES = 64
LEVEL = 3
MANIFEST = "part bigint, file string, dictionary string, documents bigint, tokens bigint"


def sliced(ids: np.ndarray) -> bytes:
    """The ids as bytes; of long ones, evenly spaced slices, the first and the last ids included."""
    size = SAMPLE_BYTES // SLICES // ids.itemsize
    if ids.nbytes <= SAMPLE_BYTES:
        return ids.tobytes()
    starts = np.linspace(0, len(ids) - size, SLICES).astype(np.int64)
    return b"".join(ids[start : start + size].tobytes() for start in starts)


def _serialized(tokenizer: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        last = np.array([end], enc.dtype)
        for batch in batches:
            for block, found in enc.in_blocks(batch, "text"):
                data = [sliced(np.concatenate([found[i], last])) for i in range(block.num_rows)]
                yield pa.RecordBatch.from_arrays([pa.array(data, pa.binary())], ["data"])

    return run


def trained(samples: list[bytes]) -> bytes:
    """A dictionary of bounded size; the samples themselves where there are too few to train on."""
    if len(samples) >= LEAST_SAMPLES:
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        except zstandard.ZstdError:  # too little variety to train on
            pass
    return b"".join(samples)[:DICTIONARY_BYTES]


def train(rows: DataFrame, tokenizer: str, end: int) -> bytes:
    chosen = rows.select("id").orderBy(F.xxhash64("id")).limit(SAMPLE_ROWS).distinct()
    # At most SAMPLE_ROWS identifiers; an identifier may repeat, so the rows are limited again.
    sample = rows.join(F.broadcast(chosen), "id", "left_semi").select("text").limit(SAMPLE_ROWS)
    found = sample.mapInArrow(_serialized(tokenizer, end), "data binary").collect()
    return trained(sorted(bytes(r.data) for r in found))


@functools.lru_cache(maxsize=4)
def dictionary(uri: str) -> tuple[bytes, zstandard.ZstdCompressionDict | None]:
    """Hash and content; one per worker process and dictionary file."""
    with open_old(uri) as file:
        data = file.read()
    return hashlib.sha256(data).digest(), zstandard.ZstdCompressionDict(data) if len(data) >= 8 else None


def _write(tokenizer: str, end: int, folder: str, shared: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        last = np.array([end], enc.dtype)
        digest, content = dictionary(shared)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=content)
        part, file = TaskContext.get().partitionId(), None
        index, at, tokens = [], struct.calcsize(HEAD), 0
        for batch in batches:
            for block, found in enc.in_blocks(batch, "text"):
                if not block.num_rows:
                    continue
                if file is None:
                    uri, file = open_new(folder, f"part-{part:06d}", ".ids")
                    file.write(struct.pack(HEAD, MAGIC, digest, enc.dtype.itemsize))
                sizes = []
                for i in range(block.num_rows):
                    frame = press.compress(np.concatenate([found[i], last]).tobytes())
                    file.write(frame)
                    sizes.append(len(frame))
                offsets = at + np.concatenate([[0], np.cumsum(sizes)])
                index.append(
                    pa.RecordBatch.from_arrays(
                        [block.column("id"), *map(pa.array, (offsets[:-1], np.array(sizes), found.sizes + 1))],
                        ["id", "offset", "size", "n_tokens"],
                    )
                )
                at, tokens = int(offsets[-1]), tokens + int(found.sizes.sum()) + block.num_rows
        if file is None:
            return
        sink = pa.BufferOutputStream()
        with pa.ipc.new_file(sink, index[0].schema) as writer:
            for entry in index:
                writer.write_batch(entry)
        data = sink.getvalue()
        file.write(data)
        file.write(struct.pack(TAIL, len(data), MAGIC))
        file.close()
        row = [[part], [uri], [digest.hex()], [sum(e.num_rows for e in index)], [tokens]]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, row)), ["part", "file", "dictionary", "documents", "tokens"])

    return run


def write(
    docs: DataFrame, tokenizer: str, end: int, folder: str, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Write the ids of each whole text, and ``end`` after them, to files below ``folder``.

    Returns the manifest, one row per file: part, file, dictionary (its hash), documents, tokens. Only
    files it lists count; a task that ran twice leaves a file that nobody reads. Null texts are
    empty, null identifiers come first, and rows that repeat an identifier are all written. An empty
    table gives an empty manifest; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    uri, file = open_new(folder, "dictionary", ".zdict")
    with file:
        file.write(train(rows, tokenizer, end))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The second key spreads an identifier that very many rows share.
    dealt = rows.withColumn("dealt", F.xxhash64(F.monotonically_increasing_id()))
    placed = dealt.repartitionByRange(parts, F.col("id").asc_nulls_first(), "dealt")
    placed = placed.sortWithinPartitions(F.col("id").asc_nulls_first(), "dealt").select("id", "text")
    return settle(placed.mapInArrow(_write(tokenizer, end, folder, uri), MANIFEST), f"{folder}/manifest")


class TokenFile:
    """Reads one file, whole or by document."""

    def __init__(self, uri: str, shared: str):
        self.file = open_old(uri)
        magic, digest, width = struct.unpack(HEAD, self.file.read(struct.calcsize(HEAD)))
        known, content = dictionary(shared)
        if magic != MAGIC or digest != known:
            raise ValueError(f"{uri} was not written with the dictionary {shared}")
        self.dtype = np.dtype(f"<u{width}")
        self.press = zstandard.ZstdDecompressor(dict_data=content)
        end = self.file.size()
        self.file.seek(end - struct.calcsize(TAIL))
        length, magic = struct.unpack(TAIL, self.file.read(struct.calcsize(TAIL)))
        if magic != MAGIC:
            raise ValueError(f"{uri} has no end")
        self.file.seek(end - struct.calcsize(TAIL) - length)
        self.index = pa.ipc.open_file(pa.py_buffer(self.file.read(length)))

    def batches(self) -> Iterator[pa.RecordBatch]:
        return (self.index.get_batch(i) for i in range(self.index.num_record_batches))

    def ids(self, offset: int, size: int) -> np.ndarray:
        self.file.seek(offset)
        return np.frombuffer(self.press.decompress(self.file.read(size)), self.dtype)

    def document(self, id) -> list[np.ndarray]:
        """The ids of all rows with an identifier."""
        found = []
        for batch in self.batches():
            rows = zip(*(batch.column(c).to_pylist() for c in ("id", "offset", "size")))
            found += [self.ids(offset, size) for key, offset, size in rows if key == id]
        return found


def dictionary_file(folder: str, digest: str) -> str:
    """The dictionary of a manifest by its hash."""
    for uri in _listed(folder):
        if dictionary(uri)[0].hex() == digest:
            return uri
    raise FileNotFoundError(f"no dictionary {digest} in {folder}")


def _listed(folder: str) -> list[str]:
    system, path = file_system(folder)
    scheme = folder.partition("://")[0] + "://" if "://" in folder and not folder.startswith("file:") else ""
    return [scheme + f.path for f in system.get_file_info(FileSelector(path)) if f.path.endswith(".zdict")]


def _read(shared: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for listed in batches:
            for uri, before in zip(listed.column("file").to_pylist(), listed.column("before").to_pylist()):
                source = TokenFile(uri, shared)
                for batch in source.batches():
                    n = batch.column("n_tokens").to_numpy()
                    places = zip(batch.column("offset").to_pylist(), batch.column("size").to_pylist())
                    crcs = [zlib.crc32(source.ids(*p).astype("<u4")) for p in places]
                    starts = before + np.cumsum(n) - n
                    before += int(n.sum())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id"), pa.array(starts), pa.array(n), pa.array(crcs, pa.int64())],
                        ["id", "start", "n_tokens", "ids_crc32"],
                    )

    return run


def read(manifest: DataFrame, folder: str, kind: str = "bigint") -> DataFrame:
    """What the files hold: per document ``id``, ``start`` (ids of all documents before it),
    ``n_tokens`` and ``ids_crc32`` of its ids as unsigned 32-bit integers."""
    spark = manifest.sparkSession
    # One row per file.
    listed = sorted(manifest.select("part", "file", "tokens", "dictionary").collect())
    schema = f"id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint"
    if not listed:
        return spark.createDataFrame([], schema)
    ends = np.cumsum([r.tokens for r in listed])
    rows = [(r.part, r.file, int(e) - r.tokens) for r, e in zip(listed, ends)]
    files = spark.createDataFrame(rows, "part bigint, file string, before bigint")
    shared = dictionary_file(folder, listed[0].dictionary)
    return spread(files, "part").mapInArrow(_read(shared), schema)
