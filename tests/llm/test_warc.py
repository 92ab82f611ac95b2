import base64
import hashlib

import pyarrow as pa
import pytest
from frames import TEXTS, documents, empty
from pyspark.sql import functions as F

from tidemark.llm import warc
from tidemark.llm.queries import op7_warc
from tidemark.llm.shared import read_table


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_query_equals_brute_force(spark, sf_dir):
    rows = sorted(map(tuple, read_table(spark, sf_dir, "pages").select("page_id", "html").collect()))
    first, expected = {}, []
    for i, html in rows:
        head = first.setdefault(html or "", i)
        kind = ("response", None) if head == i else ("revisit", head)
        expected.append((i, len((html or "").encode()), digest(html), *kind))
    assert sorted(map(tuple, op7_warc(spark, sf_dir).collect())) == expected


def test_awkward_rows(spark, tmp_path):
    pages = documents(spark).withColumnRenamed("doc_id", "page_id").withColumnRenamed("text", "html")
    found = warc.read(warc.write(pages, f"file://{tmp_path}/w")).collect()
    assert len(found) == len(TEXTS) and not any(r.reason for r in found)
    groups = {t or "": [] for _, t in TEXTS}
    for r in found:
        groups[next(t for t in groups if digest(t) == r.payload_digest)].append(r)
    for text, rows in groups.items():
        heads = [r for r in rows if r.record_type == "response"]
        assert len(heads) == 1 and bytes(heads[0].payload) == text.encode()
        ids = [i for i, t in TEXTS if (t or "") == text and i is not None]
        assert heads[0].page == (str(min(ids)) if ids else None)
        assert all(r.payload_bytes == len(text.encode()) for r in rows)
        assert all(r.refers_to == heads[0].page for r in rows if r.record_type == "revisit")
    assert warc.read(warc.write(empty(spark).selectExpr("doc_id page_id", "text html"), f"file://{tmp_path}/e")).count() == 0


def shuffled(spark, feed):
    """5,000 pages of 50 payloads, fed in ways that may order them anew at each reading."""
    pages = spark.range(5000).selectExpr("id page_id", "concat('payload ', id % 50) html")
    if feed == "repeated ids":
        pages = pages.withColumn("page_id", F.col("page_id") % 50)
    if feed == "null ids":
        pages = pages.withColumn("page_id", F.lit(None).cast("bigint"))
    if feed == "join":
        return pages.join(spark.range(0, 5000, 1, 7).withColumnRenamed("id", "page_id"), "page_id")
    return pages.repartition(6)


@pytest.mark.parametrize("feed", ["repartition", "repeated ids", "null ids", "join"])
def test_every_payload_is_in_one_response(spark, tmp_path, feed):
    found = warc.read(warc.write(shuffled(spark, feed), f"file://{tmp_path}/w")).collect()
    assert len(found) == 5000
    heads = [r for r in found if r.record_type == "response"]
    assert sorted(bytes(r.payload).decode() for r in heads) == sorted(f"payload {n}" for n in range(50))
    page = {r.payload_digest: r.page for r in heads}
    assert all(r.refers_to == page[r.payload_digest] for r in found if r.record_type == "revisit")


def test_the_query_refuses_a_payload_without_response(spark, sf_dir, monkeypatch):
    write = warc.write

    def lossy(pages, folder):
        return write(pages.withColumn("html", F.concat("html", F.lit("!"))), folder)

    monkeypatch.setattr(warc, "read", lambda *a, read=warc.read, **k: read(*a, **k).replace("response", "revisit", "record_type"))
    monkeypatch.setattr(warc, "write", lossy)
    with pytest.raises(ValueError, match="payloads are in 0 response"):
        op7_warc(spark, sf_dir)


def test_small_payloads_are_all_responses(spark, tmp_path):
    pages = spark.createDataFrame([(1, "ab"), (2, "ab"), (3, "abcd"), (4, "abcd")], "page_id bigint, html string")
    found = warc.read(warc.write(pages, f"file://{tmp_path}/w", least=3)).collect()
    assert sorted((r.page, r.record_type) for r in found) == [
        ("1", "response"), ("2", "response"), ("3", "response"), ("4", "revisit")
    ]


MEMBERS = [warc.response(i, "http://x/", (f"<p>{i}</p>" * (i * 700 + 1)).encode()) for i in range(8)]


def salvage(data):
    source = warc.Salvager(pa.BufferReader(data))
    return [r.headers["warc-record-id"] for r in source.records()], source.gaps


@pytest.mark.parametrize("pack", [warc.member, bytes])
def test_salvage(pack):
    parts = [pack(m) for m in MEMBERS]
    names = [f"<urn:page:{i}>" for i in range(8)]
    assert salvage(b"".join(parts)) == (names, [])
    at = sum(map(len, parts[:3]))
    broken = bytearray(b"".join(parts))
    broken[at + len(parts[3]) // 2] ^= 0xFF
    found, gaps = salvage(bytes(broken))
    assert found == names[:3] + names[4:] and [g[:2] for g in gaps] == [(at, at + len(parts[3]))]
    found, gaps = salvage(b"junk" + b"".join(parts[:2]) + warc.MEMBER + b"\0" * 50 + b"".join(parts[2:])[:-3])
    assert found == names[:7] and len(gaps) == 3
    assert salvage(b"") == ([], []) and salvage(b"nothing here")[1] == [(0, 12, "version line")]


def test_a_header_value_stays_on_its_line(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://x/\r\nWARC-Type: metadata", "a")], "page_id bigint, url string, html string")
    (found,) = warc.read(warc.write(pages, f"file://{tmp_path}/w")).collect()
    assert found.record_type == "response"


def foreign(number, kind, content_type, block, digest=True):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{number}>", f"Content-Type: {content_type}"]
    if digest:
        lines.append(f"WARC-Block-Digest: sha1:{warc.base32_sha1(block)}")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_blocks_that_are_not_http_are_payload_as_a_whole():
    texts = [b"one paragraph\r\n\r\nContent-Length: 3\r\n\r\nanother", b"no blank line", b""]
    parts = [foreign(n, "conversion", "text/plain", text) for n, text in enumerate(texts)]
    found = list(warc.Salvager(pa.BufferReader(b"".join(map(warc.member, parts)))).records())
    assert [r.payload() for r in found] == texts and [r.payload_bytes() for r in found] == list(map(len, texts))
    http = b"HTTP/1.1 200 OK\r\nContent-Length: x\r\n\r\nbody\r\n\r\nmore"
    (found,) = warc.Salvager(pa.BufferReader(foreign(1, "response", "application/http; msgtype=response", http))).records()
    assert found.payload() == b"body\r\n\r\nmore" and found.payload_bytes() == 12


def test_several_records_in_a_member():
    names = [f"<urn:page:{i}>" for i in range(8)]
    assert salvage(warc.member(b"".join(MEMBERS))) == (names, [])
    two = [warc.member(b"".join(MEMBERS[:5])), warc.member(b"".join(MEMBERS[5:]))]
    assert salvage(b"junk" + b"".join(two)) == (names, [(0, 4, "version line")])
    # A record in the middle fails its digest, and bytes that are no record follow the last one.
    broken = MEMBERS[:2] + [MEMBERS[2].replace(b"<p>2</p>", b"<p>X</p>", 1)] + MEMBERS[3:] + [b"junk WARC/1.1\r\n"]
    found, gaps = salvage(warc.member(b"".join(broken)))
    assert found == names[:2] + names[3:] and len(gaps) == 2
    start = len(MEMBERS[0] + MEMBERS[1])
    assert gaps[0][2].endswith(f"bytes {start} to {start + len(MEMBERS[2])} of the member")
    # A length beyond the member.
    long = MEMBERS[1].replace(b"Content-Length: ", b"Content-Length: 9999999", 2)
    assert salvage(warc.member(MEMBERS[0] + long + MEMBERS[2]))[0] == [names[0], names[2]]


def test_damaged_member_of_several_records():
    names = [f"<urn:page:{i}>" for i in range(8)]
    whole = warc.member(b"".join(MEMBERS))
    found, gaps = salvage(whole[:-3] + warc.member(MEMBERS[0]))
    assert found == names[:7] + names[:1] and len(gaps) == 1
    assert gaps[0][:2] == (0, len(whole) - 3)
    # Without digests nothing vouches for the records of a damaged member.
    bare = [foreign(n, "resource", "text/plain", b"text" * 9, digest=False) for n in range(3)]
    assert salvage(warc.member(b"".join(bare))) == (names[:3], [])
    assert salvage(warc.member(b"".join(bare))[:-3])[0] == []


def test_large_member_is_read_in_parts(monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 64)
    names = [f"<urn:page:{i}>" for i in range(8)]
    assert salvage(warc.member(b"".join(MEMBERS))) == (names, [])
    junk = b"".join(m + b"-" * 1000 + b"WARC/" for m in MEMBERS)
    found, gaps = salvage(warc.member(junk))
    assert found == names and len(gaps) == 8


def test_query_compares_with_the_manifest(spark, sf_dir, monkeypatch):
    write = warc.write
    monkeypatch.setattr(warc, "write", lambda *a: write(*a).selectExpr("part", "file", "records + 1 AS records"))
    with pytest.raises(ValueError, match="records could be read"):
        op7_warc(spark, sf_dir)
