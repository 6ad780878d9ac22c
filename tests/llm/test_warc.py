"""Operator 1: round trips through archives, and archives written by hand."""

import gzip
import hashlib
import os
import uuid

from pyspark.sql import functions as F

from larder.llm import warc
from larder.llm.tables import ready
from larder.session import fresh_folder

from .conftest import by_row

PAGES = "page_id long, url string, html string"
COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "n_requests", "n_metadata")
BIG, OTHER = "<p>" + "é" * 600, "x" * 1000
SPLIT = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nz"


def expected(rows):
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == payload and p is not None]
        first = max(same) if len(payload) >= 1000 and same else None
        refers = first if first is not None and first != page else None
        out.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "response" if refers is None else "revisit", refers, 1, 1))
    return sorted(out, key=lambda r: [(x is not None, x) for x in r])


def trip(spark, rows):
    ready(spark)
    pages = spark.createDataFrame(rows, PAGES).withColumns({"digest": F.lit("clash"), "payload": F.lit(1), "first": F.lit(2), "head": F.lit(3)})
    return warc.page_captures(spark, pages, fresh_folder(spark, "archives"))


def test_pages_come_back(spark):
    rows = [
        (1, "http://a.example/x?y#z", BIG), (2, "https://b.example", BIG), (9, None, BIG), (3, "", OTHER), (4, "odd", OTHER[:-1]), (5, "odd", OTHER[:-1]),
        (6, "http://a.example/", None), (7, "http://a.example/", ""), (8, "u\r\nWARC-Type: x", "a\r\n\r\nb\x00"), (10, "u", "\r\n\r\n"), (11, "u", "word " * 200_000),
    ]
    assert by_row(trip(spark, rows), *COLUMNS) == expected(rows)


def test_repeated_and_missing_ids(spark):
    rows = [(1, "a", OTHER), (3, "a", OTHER), (3, "a", OTHER), (None, "b", OTHER), (None, "c", BIG), (None, "c", BIG)]
    assert by_row(trip(spark, rows), *COLUMNS[:5]) == [r[:5] for r in expected(rows)]


def test_no_pages(spark):
    assert trip(spark, []).count() == 0


def test_payload_that_looks_like_a_record(spark):
    rows = [(1, "u", SPLIT), (2, "v", "plain"), (3, "w", SPLIT * 300), (4, "w", SPLIT * 300)]
    assert by_row(trip(spark, rows), *COLUMNS) == expected(rows)


def test_many_copies_refer_to_the_last(spark):
    rows = [(k, f"http://h/{k}", BIG if k % 3 else f"{k} " * 300) for k in range(400)]
    assert by_row(trip(spark, rows), *COLUMNS) == expected(rows)


def record(kind, record_id, block, *headers, http=False):
    content = "application/http; msgtype=x" if http else "text/plain"
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"Content-Type: {content}", *headers, f"content-length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def archive(spark, *members):
    """A folder with one archive of gzip members and one plain archive, with the same records."""
    folder = fresh_folder(spark, "archive").removeprefix("file://")
    os.makedirs(folder)
    name = uuid.uuid4().hex
    with open(f"{folder}/{name}.warc.gz", "wb") as file:
        for data in members:
            file.write(gzip.compress(data))
    with open(f"{folder}/{name}.warc", "wb") as file:
        file.write(b"".join(members))
    return "file://" + folder


def test_foreign_archives_are_read(spark):
    ready(spark)
    binary = bytes(range(256)) * 8
    folder = archive(
        spark,
        record("warcinfo", "i", b"software: x"),
        record("response", "r", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n" + binary, "WARC-Target-URI: http://x/", "WARC-Payload-Digest: sha1:abc", http=True),
        record("request", "q", b"GET / HTTP/1.1\r\n\r\n", "WARC-Concurrent-To: <r>", http=True),
        record("resource", "s", b""),
    )
    got = warc.read_archives(spark, folder)
    assert got.count() == 8
    assert {bytes(r["payload"]) for r in got.filter("type = 'response'").collect()} == {binary}
    first = got.filter("record_id = '<r>'").first()
    assert first["http_head"].startswith("HTTP/1.1 200 OK") and first["target_uri"] == "http://x/" and first["declared_digest"] == "sha1:abc"
    assert {bytes(r["payload"]) for r in got.filter("type = 'resource'").collect()} == {b""}


def test_assembly_follows_identifiers_in_both_directions(spark):
    ready(spark)
    folder = archive(
        spark,
        record("response", "r1", b"HTTP/1.1 200 OK\r\n\r\none", "WARC-Concurrent-To: <q1>", http=True),
        record("request", "q1", b"GET /1", "X: y"),
        record("metadata", "m1", b"about q1", "WARC-Concurrent-To: <q1>"),
        record("metadata", "m2", b"about r1", "WARC-Concurrent-To: <r1>", "WARC-Concurrent-To: <q1>"),
        record("revisit", "r2", b"", "WARC-Refers-To: <r1>"),
        record("request", "q2", b"GET /2", "WARC-Concurrent-To: <r2>"),
        record("response", "r3", b"HTTP/1.1 404 No\r\n\r\n", http=True),
        record("request", "lost", b"GET /3", "WARC-Concurrent-To: <nowhere>"),
    )
    records = warc.read_archives(spark, folder).filter(F.col("path").endswith(".warc"))
    got = {}
    for r in warc.assemble(records).collect():
        got[r["record"]["record_id"]] = ([x["record_id"] for x in r["requests"]], [x["record_id"] for x in r["metadata"]])
    assert got == {"<r1>": (["<q1>"], ["<m1>", "<m2>"]), "<r2>": (["<q2>"], []), "<r3>": ([], [])}
    assert bytes(warc.assemble(records).filter("record.record_id = '<r1>'").first()["record"]["payload"]) == b"one"
    assert warc.assemble(records.filter("false")).count() == 0


def test_archives_are_valid_and_compressed(spark):
    ready(spark)
    folder = fresh_folder(spark, "archives")
    pages = spark.createDataFrame([(1, "http://a/b", "hello"), (2, "http://a/c", BIG), (3, "http://a/d", BIG)], PAGES)
    warc.write_archives(warc.captures(pages), folder)
    local = folder.removeprefix("file://")
    data = b"".join(gzip.open(f"{local}/{f}").read() for f in sorted(os.listdir(local)) if f.endswith(".gz"))
    records = list(warc.parse_file(data))
    kinds = sorted(head.split("WARC-Type: ")[1].split("\r\n")[0] for head, _ in records)
    assert kinds == ["metadata"] * 3 + ["request"] * 3 + ["response"] * 2 + ["revisit"]
    assert sum(len(head.encode()) + 2 + len(block) + 4 for head, block in records) == len(data)
    revisit = next(block for head, block in records if "revisit" in head)
    assert revisit.endswith(b"\r\n\r\n") and f"Content-Length: {len(BIG.encode())}".encode() in revisit
