"""ARC files, their conversion to WARC, and WARC files read back."""

import base64
import gzip
import hashlib
from collections import Counter

import pytest

from graphcluster.llm import registry, warc
from graphcluster.session import scratch_dir

PAGES = "page_id long, url string, html string"
ROWS = [(5, "http://a b/\n", "<p>x\r\n\r\nWARC/1.1\r\n"), (3, None, "<p>x\r\n\r\nWARC/1.1\r\n"), (None, "", None),
        (9, "u", ""), (9, "u", ""), (1, "é ü", "é" * 10), (None, "q", "é" * 10), (12, "v", "\nhttp://x 0 0 0 5\n"),
        (13, "w", "y" * 50_000)]


def brute(rows, min_bytes=0):
    first, out = {}, Counter()
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    for i in order:
        page, _, html = rows[i]
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        again = len(raw) >= min_bytes and digest in first
        out[page, len(raw), digest, "revisit" if again else "response", first[digest] if again else None] += 1
        first.setdefault(digest, page)
    return out


def told(df):
    return Counter(tuple(r) for r in df.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())


@pytest.mark.parametrize("version", [None, 1, 2])
def test_round_trip(spark, version, monkeypatch):
    df = spark.createDataFrame(ROWS, PAGES).repartition(3)
    folder = warc.archive_pages(df, version=version)
    read = warc.read_warc(spark, folder, payloads=True)
    assert told(read) == brute(ROWS)
    by_id = {r.record_id: r for r in read.collect()}
    assert len(by_id) == len(ROWS)
    texts = {r.payload_digest: bytes(r.payload) for r in by_id.values() if r.record_type == "response"}
    assert sorted(texts.values()) == sorted({(h or "").encode() for _, _, h in ROWS})
    assert {r.url for r in by_id.values()} >= {"http://a%20b/%0A", "-", "u"}
    assert {r.warc_date for r in by_id.values()} == {"2024-01-01T00:00:00Z"}


def test_shortest_payload_of_a_revisit(spark):
    df = spark.createDataFrame(ROWS, PAGES)
    assert told(warc.read_warc(spark, warc.archive_pages(df, min_bytes=19))) == brute(ROWS, 19)


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "u", "h", "z")], PAGES + ", payload_digest string")
    assert told(warc.read_warc(spark, warc.archive_pages(df))) == brute([(1, "u", "h")])
    assert warc.read_warc(spark, warc.archive_pages(df.where("false"))).count() == 0


def test_large_files_are_cut_and_small_joins_are_not_needed(spark, monkeypatch):
    """Without a broadcast a payload of a third of all records takes the join's skew path."""
    rows = [(i, f"u{i}", "same" if i % 3 == 0 else f"text {i}") for i in range(300)]
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 5000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        folder = warc.archive_pages(spark.createDataFrame(rows, PAGES))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert told(warc.read_warc(spark, folder)) == brute(rows)


def test_query_equals_sql(spark, sf, duck):
    got = told(registry.queries()["op12_arc_to_warc"](spark, sf))
    assert got == Counter(duck.execute(registry.oracle_sql()["op12_arc_to_warc"]).fetchall())


def test_written_files_follow_the_formats(spark):
    arc = scratch_dir(spark, "test-arc")
    warc.write_arc(spark.createDataFrame(ROWS, PAGES), arc, 2)
    files = [gzip.decompress(r.content) for r in warc._files(spark, arc).collect()]
    for data in files:
        lines = data.split(b"\n")
        assert lines[0].startswith(b"filedesc://") and lines[1].startswith(b"2 0 ")
        assert lines[2].decode() == warc.FIELDS[2]
        found = list(warc.arc_records(data))
        assert sum(len(b) for _, _, b in found) < len(data)
        for fields, at, body in found[1:]:
            assert int(fields["Offset"]) == at and int(fields["Archive-length"]) == len(body)
    folder = warc.archive_pages(spark.createDataFrame(ROWS, PAGES))
    for r in warc._files(spark, folder).collect():
        data = gzip.decompress(r.content)
        assert data.startswith(b"WARC/1.1\r\nWARC-Type: ") and data.endswith(b"\r\n\r\n")
        kinds = Counter(warc.header(head, "WARC-Type") for head, _ in warc.warc_records(data))
        assert set(kinds) <= {"warcinfo", "response", "revisit"}


def test_records_that_are_no_http_message_become_resources():
    fields = {"URL": "dns:example.com", "IP-address": "1.2.3.4", "Archive-date": "19970101", "Content-type": "text/dns"}
    made = warc.convert("x.arc", 77, fields, b"a record\n", None)
    (head, block), = warc.warc_records(made)
    assert block == b"a record\n" and warc.header(head, "WARC-Type") == "resource"
    assert warc.header(head, "WARC-Date") == "1997-01-01T00:00:00Z"


def test_broken_archives_raise():
    good = warc.arc_head(1, "x.arc", warc.CAPTURED)
    body = warc.http_message(1, b"text")
    line = warc.arc_line(1, "u", warc.CAPTURED, "text/html", body, "200", 0, "x.arc")
    assert [b for _, _, b in warc.arc_records(good + line + body + b"\n")][1] == body
    two = warc.arc_head(2, "x.arc", warc.CAPTURED)
    wrong = warc.arc_line(2, "u", warc.CAPTURED, "text/html", body, "200", 0, "x.arc") + body[:-1] + b"T\n"
    for data in (good + line + body[:-3], good + b"u 0 x\n", line + body, two + wrong, two + line + body):
        with pytest.raises(ValueError, match="ARC"):
            list(warc.arc_records(data))
    whole = warc.warc_record([("WARC-Type", "response")], b"block")
    for data in (whole[:-6], b"WARC/1.1\r\n\r\n\r\n\r\n", b"x" + whole):
        with pytest.raises(ValueError, match="WARC"):
            list(warc.warc_records(data))
