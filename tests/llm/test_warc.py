import hashlib
import io
import struct

import pytest
from pyspark.sql import functions as F
import zstandard

from tests.llm.fixtures import TINY, needs_tables
from ticketflow.llm import queries
from ticketflow.llm import warc as op


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def slow(rows):
    out, raw = [], [(i, (h or "").encode()) for i, _, h in rows]
    for i, b in raw:
        same = sorted(j for j, c in raw if c == b and j is not None)
        again = len(b) >= 100 and bool(same) and i != same[0]
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", same[0] if again else None))
    return sorted(out, key=str)


def got(spark, rows):
    return sorted((tuple(r) for r in op.round_trip(spark, pages(spark, rows)).collect()), key=str)


def test_round_trip_with_copies_and_awkward_rows(spark):
    long, edge = "Zürich 漢字 " * 40_000, "x" * 100
    rows = [(1, "http://a/ b\r\nX: y", long), (2, None, long), (3, "", edge), (4, "u", edge), (5, "u", "x" * 99), (6, "u", "x" * 99),
            (7, "u", None), (8, "u", ""), (None, "u", edge), (None, None, None), (9, "u", "WARC/1.1\r\n\r\n\r\n" * 20), (9, "u", "WARC/1.1\r\n\r\n\r\n" * 20),
            (-4, "u", long)]
    assert got(spark, rows) == slow(rows)
    assert got(spark, [(None, "u", edge), (None, "v", edge)]) == slow([(None, "u", edge), (None, "v", edge)])
    assert got(spark, []) == []


@needs_tables
def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{TINY}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted((tuple(r) for r in queries.op9_warc(spark, TINY).collect()), key=str) == slow(rows)


def archive(tmp_path, records, dictionary=b""):
    w = op.ArchiveWriter(str(tmp_path), dictionary)
    for r in records:
        w.write(r)
    w.close()
    return (tmp_path / w.done[0][0]).read_bytes()


def record(k, payload=b"<p>hello</p>"):
    return op.build_record(k, "http://x/", payload, len(payload), hashlib.sha256(payload).hexdigest(), None)


def test_dictionary_comes_from_the_leading_frame(tmp_path):
    samples = [f"<html><body><p>page {k} of a site with much in common</p></body></html>".encode() * 3 for k in range(200)]
    trained = op.train_dictionary(samples)
    assert trained
    raw = archive(tmp_path, [record(k, s) for k, s in enumerate(samples)], trained)
    assert raw[:4] == struct.pack("<I", 0x184D2A5D) and raw[8:8 + len(trained)] == trained
    back = [op.parse_record(r) for r in op.read_archive(io.BytesIO(raw))]
    assert [b["payload"] for b in back] == samples and back[3]["page_id"] == 3
    packed = zstandard.compress(trained)  # the dictionary itself may be compressed
    other = struct.pack("<II", 0x184D2A5D, len(packed)) + packed + raw[8 + len(trained):]
    assert len(list(op.read_archive(io.BytesIO(other)))) == 200
    with pytest.raises(zstandard.ZstdError):
        list(op.read_archive(io.BytesIO(raw[8 + len(trained):])))


def test_frames_hold_one_record_and_other_skippable_frames_are_passed(tmp_path):
    raw = archive(tmp_path, [record(1), record(2)])
    assert len(list(op.read_archive(io.BytesIO(raw + struct.pack("<II", 0x184D2A50, 3) + b"abc" + raw)))) == 4
    for cut in (1, 3, len(raw) // 2 + 1, len(raw) - 1):
        with pytest.raises(op.BadRecord):
            list(op.read_archive(io.BytesIO(raw[:cut])))
    with pytest.raises(op.BadRecord):
        list(op.read_archive(io.BytesIO(raw + b"junk")))


@pytest.mark.parametrize("spoil", [
    lambda r: r[:-1], lambda r: r + b"x", lambda r: r.replace(b"WARC/1.1", b"HARC/1.1"), lambda r: r.replace(b"hello", b"hellO"),
    lambda r: r.replace(b"WARC-Date", b"WARC-Data"), lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: other"),
    lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: revisit"), lambda r: r.replace(b"Content-Length: ", b"Content-Length: -"),
    lambda r: r.replace(b"Content-Length: 12", b"Content-Length: 13"), lambda r: r.replace(b"WARC-Type:", b"WARC-Type")])
def test_broken_records_are_refused(spoil):
    assert op.parse_record(record(1))["payload"] == b"<p>hello</p>"
    with pytest.raises(op.BadRecord):
        op.parse_record(spoil(record(1)))


def test_archives_are_of_bounded_size(tmp_path, monkeypatch):
    monkeypatch.setattr(op, "ARCHIVE_RECORDS", 3)
    w = op.ArchiveWriter(str(tmp_path), b"")
    for k in range(7):
        w.write(record(k))
    w.close()
    assert [n for _, n in w.done] == [3, 3, 1]


def test_stores_are_named_as_arrow_names_them():
    assert op.store_uri("s3a://bucket/a b/c") == "s3://bucket/a b/c"
    assert op.store_uri("abfss://box@host/x") == "abfs://box@host/x"
    assert op.store_uri("hdfs://host:8020/x") == "hdfs://host:8020/x" and op.store_uri("/tmp/x") == "/tmp/x"
    for path in ("/tmp/x y", "file:/tmp/x y", "file:///tmp/x y"):
        assert op.open_store(path)[1] == "/tmp/x y"


def test_frames_across_reads_of_any_size(tmp_path, monkeypatch):
    monkeypatch.setattr(op, "_FEED", 7)
    writer = op.ArchiveWriter(str(tmp_path), b"")
    records = [bytes([k % 251]) * (k * 37 % 900) + b"x" for k in range(60)]
    for r in records:
        writer.write(r)
    writer.close()
    for size in (1, 13, 1 << 20):
        monkeypatch.setattr(op, "_READ", size)
        with open(tmp_path / writer.done[0][0], "rb") as f:
            assert list(op.read_archive(f)) == records


def test_tables_with_other_columns(spark):
    rows = spark.createDataFrame([(1, "<p>a</p>" * 40), (2, "<p>a</p>" * 40), (3, None)], "page_id long, html string")
    plain = sorted(map(tuple, op.round_trip(spark, rows).collect()), key=str)
    more = rows.withColumns({n: F.lit("x") for n in ("url", "payload", "payload_bytes", "payload_digest", "revisits", "refers_to",
                                                    "first", "n", "archive", "records")})
    assert sorted(map(tuple, op.round_trip(spark, more).collect()), key=str) == plain
    assert [r[3] for r in plain] == ["response", "revisit", "response"]
