"""Round trips of archives, filters decided on headers, foreign archives, and awkward rows."""

import base64
import gzip
import hashlib
from types import SimpleNamespace

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from leadlens.llm import warc

PAGES = [
    (5, "http://a/é", "<p>same</p>"), (2, "http://b/\r\nX: 1", "<p>same</p>"), (9, None, "<p>ünï🎉</p>"), (7, "http://c", None), (3, "http://d", ""),
    (2, "http://b/again", "<p>same</p>"), (None, "http://e", "<p>same</p>"), (None, "http://f", "only without an id"), (None, "http://f", "only without an id"),
    (11, "http://g", "WARC/1.1\r\n\r\nfake\r\n\r\n" * 9000), (12, "http://h", "x" * 300_000),
]
SCHEMA = "page_id long, url string, html string, payload string, record_type string"


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*p, "clash", "clash") for p in PAGES], SCHEMA).repartition(3)


def expected(least=0):
    out = []
    for page_id, _, html in PAGES:
        payload = (html or "").encode()
        same = [i for i, _, h in PAGES if (h or "") == (html or "") and i is not None]
        first = min(same) if same and len(payload) >= least else page_id
        revisit = page_id != first
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page_id, len(payload), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 12])
def test_round_trip(spark, pages, least):
    assert sorted(map(tuple, warc.warc(pages, least).collect()), key=str) == expected(least)


def test_empty_table(spark, pages):
    assert warc.warc(pages.limit(0)).count() == 0


def test_payloads_uris_and_pushed_filters(spark, pages, tmp_path):
    path = str(tmp_path / "out")
    warc.write_archives(pages, path)
    everything = warc.read_archives(spark, path)
    payloads = {(r["record_id"], r["target_uri"]): r["payload"] for r in everything.collect()}
    assert payloads["urn:page:9", ""].decode() == "<p>ünï🎉</p>" and payloads["urn:page:12", "http://h"] == b"x" * 300_000
    assert ("urn:page:2", "http://b/%0D%0AX: 1") in payloads
    one = everything.filter("record_type = 'response' AND record_id IN ('urn:page:5', 'urn:page:11')")
    assert [r["record_id"] for r in one.collect()] == ["urn:page:11"]
    assert "Filter (record_type" not in one._jdf.queryExecution().executedPlan().toString()  # taken over by the source
    assert everything.filter("target_uri LIKE 'http://b%' AND payload_bytes > 5").count() == 2
    assert warc.read_archives(spark, path, "record_id string").count() == len(PAGES)


def test_reader_leaves_unwanted_payloads(tmp_path, monkeypatch):
    """Filters and schemas decide on headers: bytes read stay far below the file's."""
    row = {"record_type": "response", "record_id": "urn:page:1", "target_uri": "u", "date": "d", "refers_to": None, "payload_digest": "D", "content_type": "application/http"}
    noise = b"".join(hashlib.sha1(bytes([i % 256, i // 256])).digest() for i in range(50_000))
    data = b"".join(warc.member(warc.record_bytes(row | {"record_id": f"urn:page:{i}", "payload_bytes": len(noise), "payload": noise})) for i in range(5))
    (tmp_path / "a.warc.gz").write_bytes(data)

    counter, member = SimpleNamespace(read=0), warc.Member
    reader = warc.WarcReader(f"file://{tmp_path}", StructType([StructField("record_id", StringType())]), "")
    monkeypatch.setattr(warc, "Member", lambda f, at: _counted(member, counter, f, at))
    rows = list(reader.records(f"file://{tmp_path}/a.warc.gz"))
    assert [r["record_id"] for r in rows] == [f"urn:page:{i}" for i in range(5)]
    assert counter.read < len(data) / 20


def _counted(member, counter, f, at):
    record = member(f, at)
    more = record.more

    def counted():
        before = record.next
        out = more()
        counter.read += record.next - before
        return out

    record.more = counted
    return record


@pytest.mark.parametrize("pack", [lambda x: x, gzip.compress], ids=["plain", "gzip"])
def test_foreign_archives(spark, tmp_path, pack):
    records = []
    for i in range(3):
        block = b"HTTP/1.1 200 OK\r\nContent-Length: 40000\r\n\r\n" + bytes([65 + i]) * 40_000
        head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:{i}>\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}\r\n\r\n"
        records.append(pack(head.encode() + block + b"\r\n\r\n"))
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Type: text/plain\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    (tmp_path / "x.warc").write_bytes(pack(info) + b"".join(records))
    rows = warc.read_archives(spark, str(tmp_path)).orderBy("record_id").collect()
    assert [(r["record_type"], r["payload_bytes"], r["payload"][:1]) for r in rows] == [
        ("warcinfo", 5, b"h"), ("response", 40000, b"A"), ("response", 40000, b"B"), ("response", 40000, b"C"),
    ]


def test_unlisted_files_are_ignored(spark, pages, tmp_path):
    """What a failed attempt of a task has left is not read."""
    path = str(tmp_path / "out")
    warc.write_archives(pages, path)
    (tmp_path / "out" / "leftover.warc.gz").write_bytes(b"broken")
    assert warc.read_archives(spark, path).count() == len(PAGES)
