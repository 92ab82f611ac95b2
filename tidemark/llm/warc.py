"""WARC archives: a writer with revisit records, and a reader that salvages damaged files.

The writer makes records gzip members of their own; the reader also takes several records in a member.
It checks each one: member and checksum, version line, header, lengths and digests. After a failed
check it searches for the next place where a member (or, in files that are not compressed and within
members, a version line) starts a record that passes all checks, goes on there, and reports the bytes
between as a gap. Of several records in a damaged member, those whose digest holds and which another
one follows are read. Nothing larger than one record is in memory.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import open_new, open_old, spread
from tidemark.sources.scratch import scratch_path, settle

VERSION = b"WARC/1.1"
VERSIONS = (b"WARC/1.0\r\n", b"WARC/1.1\r\n")
MEMBER = b"\x1f\x8b\x08"
MARK = b"WARC/1."
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK = 1 << 20
MANIFEST = "part bigint, file string, records bigint"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(number) -> str:
    return "" if number is None else str(number)


def _record(number, url: str | None, size: int, digest: str, block: bytes, *more: str) -> bytes:
    lines = [
        VERSION.decode(),
        f"WARC-Type: {'revisit' if more else 'response'}",
        f"WARC-Record-ID: <urn:page:{record_id(number)}>",
        f"WARC-Date: {DATE}",
        # Header values have one line.
        f"WARC-Target-URI: {' '.join((url or '').split())}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32_sha1(HTTP.format(size).encode() + block)}",
        *more,
        f"Content-Length: {len(HTTP.format(size)) + len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + HTTP.format(size).encode() + block + b"\r\n\r\n"


def response(number, url: str | None, payload: bytes) -> bytes:
    return _record(number, url, len(payload), base32_sha1(payload), payload)


def revisit(number, url: str | None, size: int, digest: str, refers_to: str) -> bytes:
    """A record without its payload, of which ``size`` and ``digest`` are known."""
    more = (f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}")
    return _record(number, url, size, digest, b"", *more)


def member(data: bytes) -> bytes:
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


class Damaged(ValueError):
    """A check of a record failed."""


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    def is_http(self) -> bool:
        """Whether the block is an HTTP message; those of other records are payload as a whole."""
        kind = self.headers.get("content-type", "").partition(";")[0].strip().lower()
        return kind == "application/http" if kind else self.block.startswith(b"HTTP/")

    def payload(self) -> bytes:
        return self.block.partition(b"\r\n\r\n")[2] if self.is_http() else self.block

    def payload_bytes(self) -> int:
        """Of the full payload, which a revisit does not carry: as its HTTP header says."""
        if not self.is_http():
            return len(self.block)
        head = self.block.partition(b"\r\n\r\n")[0]
        lines = ((n.strip().lower(), v.strip()) for n, _, v in (line.partition(b":") for line in head.split(b"\r\n")))
        return next((int(v) for n, v in lines if n == b"content-length" and v.isdigit()), len(self.payload()))

    def has_digest(self) -> bool:
        """Whether :func:`check` has compared a digest of the whole block or payload."""
        names = ["warc-block-digest"] + ["warc-payload-digest"] * (self.headers.get("warc-type") == "response")
        return any(self.headers.get(n, "").startswith("sha1:") for n in names)


def parse_header(data: bytes) -> dict[str, str]:
    lines = data.decode("utf-8", "replace").split("\r\n")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged("header")
        headers[name.strip().lower()] = value.strip()
    if not headers.get("content-length", "").isdecimal():
        raise Damaged("content length")
    return headers


def check(headers: dict[str, str], block: bytes, end: bytes) -> Record:
    if len(block) != int(headers["content-length"]) or end != b"\r\n\r\n":
        raise Damaged("record length")
    found = Record(headers, block)
    digest = headers.get("warc-block-digest", "")
    if digest.startswith("sha1:") and digest[5:] != base32_sha1(block):
        raise Damaged("block digest")
    digest = headers.get("warc-payload-digest", "")
    if headers.get("warc-type") == "response" and digest.startswith("sha1:"):
        if digest[5:] != base32_sha1(found.payload()):
            raise Damaged("payload digest")
    return found


def up_to_damage(press, chunk: bytes) -> bytes:
    """What ``chunk`` gives before the byte at which it fails."""
    parts, size = [], len(chunk)
    while size > 1:
        size = -(-size // 2)
        trial = press.copy()
        try:
            parts.append(trial.decompress(chunk[:size]))
        except zlib.error:
            continue
        press, chunk = trial, chunk[size:]
    return b"".join(parts)


class Inflated:
    """The decompressed bytes of the member at a place, read ahead as far as needed.

    ``data`` begins after the ``passed`` bytes dropped so far. ``end`` is the place after the member once
    its end was reached and its checksum held, ``damage`` says what went wrong before that.
    """

    def __init__(self, read, at: int):
        self.read, self.at, self.press = read, at, zlib.decompressobj(31)
        self.data, self.passed, self.end, self.damage = bytearray(), 0, None, None

    def _block(self) -> bytes:
        chunk = self.press.unconsumed_tail
        if not chunk:
            chunk = self.read(self.at, CHUNK)
            self.at += len(chunk)
        before = self.press.copy()
        try:
            block = self.press.decompress(chunk, 4 * CHUNK)
        except zlib.error:
            self.damage = "member"
            return up_to_damage(before, chunk)
        if self.press.eof:
            self.end = self.at - len(self.press.unused_data)
        elif not chunk and not block:
            self.damage = "cut off"
        return block

    def fill(self, size: int) -> bool:
        """Whether ``data`` has ``size`` bytes, after reading as much as that takes."""
        while len(self.data) < size and self.end is None and self.damage is None:
            self.data += self._block()
        return len(self.data) >= size

    def left(self) -> int:
        """Bytes from ``data`` on, counted without keeping them."""
        rest = Inflated(self.read, self.at)
        rest.press, rest.end, rest.damage, size = self.press.copy(), self.end, self.damage, len(self.data)
        while rest.end is None and rest.damage is None:
            size += len(rest._block())
        return size

    def drop(self, size: int) -> None:
        self.passed += size
        del self.data[:size]

    def skip(self) -> None:
        """On to the next version line, or to the end."""
        self.drop(1)
        while (found := self.data.find(MARK)) < 0:
            # The end of the data may be the beginning of a mark.
            self.drop(max(0, len(self.data) - len(MARK) + 1))
            if not self.fill(len(self.data) + 1):
                found = len(self.data)
                break
        self.drop(found)

    def record(self) -> tuple[Record, int]:
        """The record that ``data`` begins with, and its length."""
        if not self.fill(len(VERSIONS[0])) or not self.data.startswith(VERSIONS):
            raise Damaged("version line")
        blank = self.data.find(b"\r\n\r\n")
        while blank < 0:
            searched = len(self.data)
            if not self.fill(searched + 1):
                raise Damaged(self.damage or "header")
            blank = self.data.find(b"\r\n\r\n", searched - 3)
        headers = parse_header(bytes(self.data[:blank]))
        start = blank + 4
        size = start + int(headers["content-length"]) + 4
        # A wrong length must not bring the rest of a large member into memory.
        far = size > len(self.data) + 16 * CHUNK and size > self.left()
        if far or not self.fill(size):
            raise Damaged(self.damage or "record length")
        return check(headers, bytes(self.data[start : size - 4]), bytes(self.data[size - 4 : size])), size


class Salvager:
    """Iterates over the ``records`` of a file; ``gaps`` has (start, end, reason) of lost bytes."""

    def __init__(self, file):
        self.file = file
        self.size = file.size()
        self.gaps: list[tuple[int, int, str]] = []

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(min(size, max(0, self.size - at)))

    def _member(self, at: int) -> tuple[Iterable[Record], int, str | None]:
        member = Inflated(self._read, at)
        try:
            found, size = member.record()
            if not member.fill(size + 1):
                if member.damage:
                    raise Damaged(member.damage)
                return [found], member.end, None
            reason = None
        except Damaged as damage:
            reason = str(damage)
        while member.end is None and member.damage is None:
            member.drop(len(member.data))
            member.fill(1)
        found = self._several(at, member.end, member.damage)
        first = next(found, None)
        if first is None:
            raise Damaged(member.damage or reason or "member")
        return itertools.chain([first], found), member.end or at + 1, member.damage

    def _several(self, at: int, end: int | None, damage: str | None) -> Iterator[Record]:
        """The records of a member that holds more than one, or other bytes beside them."""
        member, lost, read = Inflated(self._read, at), None, 0
        while member.fill(1):
            try:
                found, size = member.record()
                if damage and not (found.has_digest() and member.fill(size + len(MARK)) and member.data.startswith(MARK, size)):
                    raise Damaged(damage)
            except Damaged as failed:
                lost = lost or (member.passed, str(failed))
                member.skip()
                continue
            if lost:
                self._gap_within(at, end, *lost, member.passed)
            lost, read = None, read + 1
            member.drop(size)
            yield found
        # The end of a damaged member belongs to the gap that the caller reports.
        if lost and read and not damage:
            self._gap_within(at, end, *lost, member.passed)

    def _gap_within(self, at: int, end: int | None, start: int, reason: str, stop: int) -> None:
        # Compressed bytes have no offsets of their own: those of the member, and the decompressed ones.
        self.gaps.append((at, end or self.size, f"{reason}, bytes {start} to {stop} of the member"))

    def _plain(self, at: int) -> tuple[Record, int]:
        data = self._read(at, CHUNK)
        if not data.startswith(VERSIONS):
            raise Damaged("version line")
        head, blank, _ = data.partition(b"\r\n\r\n")
        if not blank:
            raise Damaged("header")
        headers = parse_header(head)
        size = int(headers["content-length"])
        if at + len(head) + 4 + size + 4 > self.size:
            raise Damaged("cut off")
        rest = self._read(at + len(head) + 4, size + 4)
        return check(headers, rest[:-4], rest[-4:]), at + len(head) + 4 + len(rest)

    def _next(self, at: int) -> tuple[Iterable[Record], int, str | None]:
        """The records at a place, the place after them, and what damage follows them, if any."""
        if self._read(at, len(MEMBER)) == MEMBER:
            return self._member(at)
        found, end = self._plain(at)
        return [found], end, None

    def _candidates(self, at: int) -> Iterator[int]:
        """Places from ``at`` on where a member or version line may begin."""
        overlap = len(VERSIONS[0]) - 1
        while at < self.size:
            data = self._read(at, CHUNK + overlap)
            place = -1
            while True:
                hits = [p for p in (data.find(MEMBER, place + 1), data.find(MARK, place + 1)) if p >= 0]
                place = min(hits, default=CHUNK)
                if place >= CHUNK:
                    break
                yield at + place
            at += CHUNK

    def records(self) -> Iterator[Record]:
        at, lost, places = 0, None, iter(())
        while at < self.size:
            try:
                found, end, damage = self._next(at)
            except Damaged as failed:
                damage = str(failed)
            else:
                if lost:
                    self.gaps.append((lost[0], at, lost[1]))
                    lost = None
                yield from found
            if not damage:
                at = end
                continue
            if not lost:
                lost, places = (at, damage), self._candidates(at + 1)
            at = next(places, self.size)
        if lost:
            self.gaps.append((lost[0], self.size, lost[1]))


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, file, records = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page", "url", "bytes", "sha1", "refers")]
            for number, url, size, sha1, refers, html in zip(*columns, batch.column("html").cast(pa.binary())):
                if file is None:
                    uri, file = open_new(folder, f"part-{part:06d}", ".warc.gz")
                if refers is None:
                    data = response(number, url, html.as_py())
                else:
                    data = revisit(number, url, size, base64.b32encode(bytes.fromhex(sha1)).decode(), refers)
                file.write(member(data))
                records += 1
        if file is not None:
            file.close()
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([uri]), pa.array([records])], ["part", "file", "records"])

    return run


def write(pages: DataFrame, folder: str, id: str = "page_id", text: str = "html", least: int = 0) -> DataFrame:
    """Write a record per row to archives below ``folder``; returns the manifest of files that count.

    Of rows with equal payloads of at least ``least`` bytes, the one with the smallest identifier is
    a response and the others revisit it; null identifiers come last, and exactly one row is the
    response also where identifiers repeat. A null payload is an empty one. An empty table gives an
    empty manifest; other columns than ``url`` (which may be missing) are ignored.

    Which rows are responses is settled on narrow rows; payloads are then joined to them by their
    digest, one copy of each. So only contents, and no numbers of rows, tie the two reads of
    ``pages`` together: rows that arrive in another order the second time do no harm.
    """
    url = F.col("url") if "url" in pages.columns else F.lit(None).cast("string")
    html = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    narrow = settle(
        pages.select(
            F.col(f"`{id}`").alias("page"), url.alias("url"), F.sha2(html, 256).alias("digest"),
            F.sha1(html).alias("sha1"), F.octet_length(html).cast("bigint").alias("bytes"),
            F.monotonically_increasing_id().alias("place"),
        ),
        scratch_path(pages.sparkSession),
    )
    order = F.struct(F.col("page").isNull(), "page", "place")
    # Counted by hash before the shuffle, so a payload that very many pages share shrinks first.
    heads = (
        narrow.where(F.col("bytes") >= least)
        .groupBy("digest")
        .agg(F.min(order).alias("head"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", F.col("head.page").alias("head"), F.col("head.place").alias("head_place"))
    )
    revisits = F.col("head_place").isNotNull() & (F.col("head_place") != F.col("place"))
    refers = F.when(revisits, F.coalesce(F.col("head").cast("string"), F.lit("")))
    marked = narrow.join(heads, "digest", "left").withColumn("refers", refers)
    names = ("page", "url", "bytes", "sha1", "refers", "html")
    payloads = pages.select(F.sha2(html, 256).alias("digest"), html.alias("html")).dropDuplicates(["digest"])
    responses = marked.where(F.col("refers").isNull()).join(payloads, "digest").select(*names)
    others = marked.where(F.col("refers").isNotNull()).withColumn("html", F.lit("")).select(*names)
    return settle(responses.unionByName(others).mapInArrow(_write(folder), MANIFEST), f"{folder}/manifest")


def _identifier(value: str | None) -> str | None:
    return None if value is None else value.removeprefix("<urn:page:").removesuffix(">") or None


_FIELDS = {
    "file": pa.string(),
    "page": pa.string(),
    "url": pa.string(),
    "payload_bytes": pa.int64(),
    "payload_digest": pa.string(),
    "record_type": pa.string(),
    "refers_to": pa.string(),
    "payload": pa.binary(),
    "gap_start": pa.int64(),
    "gap_end": pa.int64(),
    "reason": pa.string(),
}
_SCHEMA = (
    "file string, page string, url string, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to string, payload binary, gap_start bigint, gap_end bigint, reason string"
)
BLOCK = 64


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(_FIELDS)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _FIELDS.values())], list(_FIELDS))


def _read(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("file").to_pylist():
                with open_old(uri) as file:
                    source, rows = Salvager(file), []
                    for r in source.records():
                        h = r.headers
                        rows.append((
                            uri,
                            _identifier(h.get("warc-record-id")),
                            h.get("warc-target-uri"),
                            r.payload_bytes(),
                            h.get("warc-payload-digest", "").removeprefix("sha1:"),
                            h.get("warc-type"),
                            _identifier(h.get("warc-refers-to")),
                            r.payload() if payloads else None,
                            None,
                            None,
                            None,
                        ))
                        if len(rows) == BLOCK:
                            yield _rows(rows)
                            rows = []
                    none = (None,) * 7
                    yield _rows(rows + [(uri, *none, *gap) for gap in source.gaps])

    return run


def read(files: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the archives in the column ``file``, and a row for each gap.

    Records have page, url, payload_bytes, payload_digest, record_type, refers_to and, if asked for,
    payload; gaps have gap_start, gap_end (byte offsets) and the reason, for a quarantine log.
    """
    return spread(files.select("file"), "file").mapInArrow(_read(payloads), _SCHEMA)
