"""Archives written and read back, against grouping the payloads in plain Python."""

import base64
import glob
import gzip
import hashlib
from collections import defaultdict
from datetime import datetime, timezone

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from seqlog.llm import warc
from seqlog.plans.staging import scratch_path

TRAP = "x\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
ROWS = [
    (1, "http://a.example/", "same"), (2, "http://b.example/", "same"), (7, None, "same"), (None, "http://c/", "same"),
    (3, "http://d/", TRAP), (4, "http://e/\r\nPage-ID: 99", TRAP), (5, "", ""), (6, "http://é/", None), (8, "u", "é👍"),
    (9, "u", "z" * 300_000), (10, "u", "z" * 300_000), (None, "n", "null ids only"), (None, None, "null ids only"),
    (11, "v", "repeated"), (11, "v", "repeated"), (11, "w", "repeated"), (-3, "v", "repeated"), (12, "t", "alone"),
    (13, "t", "\r\n\r\n"), (14, "t", "\n"), (15, "t", "a\x00b"),
]


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload.encode()).digest()).decode()


def by_hand(rows, least=0):
    groups = defaultdict(list)
    for page, _, payload in rows:
        groups[payload or ""].append(page)
    out = []
    for page, _, payload in rows:
        payload = payload or ""
        size = len(payload.encode())
        original = max((p for p in groups[payload] if p is not None), default=None)
        revisit = size >= least and page != original
        out.append((page, size, digest(payload), "revisit" if revisit else "response", original if revisit else None))
    return sorted(map(repr, out))


def resolved(frame):
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted(repr(tuple(r)) for r in frame.select(*columns).collect())


@pytest.fixture(scope="module")
def pages(spark):
    """Extra columns named like steps and results."""
    schema = "page_id long, url string, html string, page int, original string, sha1 string, payload string, records int"
    return spark.createDataFrame([(*r, 1, "a", "b", "c", 2) for r in ROWS], schema).repartition(4)


@pytest.mark.parametrize("least, hot, size", [(0, 100_000, 16 << 20), (5, 1, 500), (10**6, 2, 10**5)])
def test_round_trip(spark, pages, monkeypatch, least, hot, size):
    monkeypatch.setattr(warc, "HOT", hot)
    folder = scratch_path(spark, "test-warc")
    warc.write_archives(pages, folder, least_bytes=least, archive_bytes=size)
    records = warc.read_archives(spark, folder)
    assert resolved(warc.resolve(records)) == by_hand(ROWS, least)
    held = records.where("record_type = 'response'").select("page_id", F.decode("payload", "UTF-8")).collect()
    kept = [r for r in by_hand(ROWS, least) if "'response'" in r]
    assert len(held) == len(kept)
    assert {(p, t) for p, t in held} <= {(p, t or "") for p, _, t in ROWS}
    names = {r.record_id for r in records.where("record_type = 'response'").collect()}
    revisits = records.where("record_type = 'revisit'").collect()
    assert all(r.refers_to_record in names and r.payload is None and r.original is not None for r in revisits)


def test_archive_as_bytes(spark):
    """The format itself, byte by byte."""
    folder = scratch_path(spark, "test-warc")
    rows = [(1, "http://a/", "<p>é"), (2, None, "<p>é")]
    made = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archives(made, folder, date=datetime(2024, 2, 3, 4, 5, 6, tzinfo=timezone.utc), compression="none")
    (path,) = glob.glob(f"{folder.removeprefix('file:')}/part-*")
    content = open(path, "rb").read()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: 5\r\n\r\n"
    response, revisit = (
        content[content.index(b"WARC/1.1\r\nWARC-Type: " + kind) :] for kind in (b"response", b"revisit")
    )
    lines, rest = response.split(b"\r\n\r\n", 1)
    assert b"WARC-Date: 2024-02-03T04:05:06Z" in lines and b"Target-URI" not in lines
    assert f"WARC-Payload-Digest: sha1:{digest('<p>é')}".encode() in lines
    assert f"Content-Length: {len(http) + 5}".encode() in lines.split(b"\r\n")
    assert rest.startswith(http + "<p>é".encode() + b"\r\n\r\n")
    lines, rest = revisit.split(b"\r\n\r\n", 1)
    assert b"WARC-Target-URI: http://a/" in lines and f"WARC-Profile: {warc.PROFILE}".encode() in lines
    assert rest.startswith(http + b"\r\n\r\n")


def test_plain_and_foreign_records(spark):
    folder = scratch_path(spark, "test-warc")
    warc.write_archives(spark.createDataFrame(ROWS, "page_id long, url string, html string"), folder, compression="none")
    assert resolved(warc.resolve(warc.read_archives(spark, folder))) == by_hand(ROWS)
    foreign = (
        b"WARC/1.0\r\nwarc-type: warcinfo\r\nWARC-Record-ID:<a>\r\nContent-Length: 4\r\n\r\n\r\n\r\n\r\n\r\n"
        b"WARC/1.0\r\nWARC-Type: response\r\nContent-Type: text/dns\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    )
    for archive in (foreign, gzip.compress(foreign[:79]) + gzip.compress(foreign[79:])):
        (info, block), (response, payload) = warc.parsed(archive)
        assert info["warc-type"] == "warcinfo" and block == b"\r\n\r\n" and payload == b"hi"
        assert warc._record(response, payload, True)["payload_digest"] == digest("hi")


def test_damage_is_refused():
    whole = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha1:ABC\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    ((fields, block),) = warc.parsed(whole)
    with pytest.raises(ValueError, match="digest"):
        warc._record(fields, block, False)
    for broken in (whole.replace(b"Length: 2", b"Length: 3"), b"x" + whole):
        with pytest.raises(ValueError):
            list(warc.parsed(broken))


def test_revisit_without_response_fails(spark):
    folder = scratch_path(spark, "test-warc")
    rows = [(1, "u", "same"), (2, "u", "same")]
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), folder)
    with pytest.raises(PySparkException, match="no response"):
        warc.resolve(warc.read_archives(spark, folder).where("record_type = 'revisit'")).collect()


def test_empty_table(spark):
    folder = scratch_path(spark, "test-warc")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert warc.resolve(warc.read_archives(spark, folder)).collect() == []
