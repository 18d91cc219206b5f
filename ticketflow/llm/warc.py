"""Zstandard WARC archives: one frame per record, and the dictionary in a leading skippable frame.

Writing: each task streams its pages into archives of bounded size in a shared folder and
returns their names; the written list of names is the commit, so archives of lost or repeated
tasks are never read. Pages whose payload (of ``REVISIT_BYTES`` or more) is that of another page
become revisits of the one with the smallest page_id.

Reading: a task streams each archive, takes the dictionary from its skippable frame, decodes
frame by frame (memory: one record) and checks every record: version line, required fields,
lengths against the data, the closing blank lines, the digest of a response's payload.

Defined results: a null html counts as empty; rows with the same page_id and payload are equal
records of the same type; a null page_id comes after all others and is written as ``none``; a
null or empty url is written as the record's id; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketflow.llm.common import Shared, small_batches, staged
from ticketflow.session import scratch_path

REVISIT_BYTES = 100
ARCHIVE_BYTES = 64 << 20
ARCHIVE_RECORDS = 50_000
DICT_BYTES = 64 << 10
DICT_PAGES = 400
DICT_PAGE_CHARS = 16_384
CAPTURED = "2024-01-01T00:00:00Z"

_DICT_MAGIC = 0x184D2A5D
_SKIPPABLE = range(0x184D2A50, 0x184D2A60)
_ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
_READ = 1 << 20
#: Bytes that a decompressor gets at a time: what follows its frame among them is copied, and read again.
_FEED = 1 << 13
_END = b"\r\n\r\n"


class BadRecord(ValueError):
    """An archive that breaks the format."""


#: Schemes of Spark's file systems, and what Arrow calls the same stores. Others go by one name in both.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "abfss": "abfs", "wasbs": "abfs"}


def store_uri(uri: str) -> str:
    """How Arrow names a folder or file that Spark names."""
    scheme, mark, rest = uri.partition("://")
    return f"{SCHEMES.get(scheme, scheme)}://{rest}" if mark else uri


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder or file named by Spark."""
    if "://" not in uri or uri.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub(r"^file:/*", "/", uri)
    return pafs.FileSystem.from_uri(store_uri(uri))


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary from sample payloads; empty if there is nothing to learn from."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples, level=3).as_bytes() if len(samples) > 7 else b""
    except zstandard.ZstdError:
        return b""


def page_name(page_id: int | None) -> str:
    return f"urn:x-page:{'none' if page_id is None else page_id}"


def _page_id(name: str) -> int | None:
    last = name.rpartition(":")[2]
    return None if last == "none" else int(last)


def build_record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str,
                 refers_to: str | None) -> bytes:
    """One WARC record: an HTTP response, or a revisit that holds its headers alone."""
    kind = "response" if refers_to is None else "revisit"
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n").encode()
    block = http + (payload if refers_to is None else b"")
    name = page_name(page_id)
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "") or name
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{name}>"), ("WARC-Date", CAPTURED),
              ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<{refers_to}>"),
                   ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return "WARC/1.1\r\n".encode() + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + _END


def _headers(raw: bytes, first: bytes, what: str) -> tuple[dict[str, str], int]:
    end = raw.find(_END)
    if end < 0 or not raw.startswith(first):
        raise BadRecord(f"{what}: no complete header")
    out = {}
    for line in raw[:end].split(b"\r\n")[1:]:
        k, colon, v = line.partition(b":")
        if not colon or not k.strip():
            raise BadRecord(f"{what}: bad header line {line[:60]!r}")
        out[k.strip().decode("utf-8").lower()] = v.strip().decode("utf-8")
    return out, end + len(_END)


def _length(fields: dict[str, str], what: str) -> int:
    v = fields.get("content-length", "")
    if not v.isdigit():
        raise BadRecord(f"{what}: bad content length {v!r}")
    return int(v)


def parse_record(raw: bytes) -> dict:
    """A checked record: page_id, type, refers_to, url, digest, payload size, payload (response)."""
    fields, at = _headers(raw, b"WARC/1.", "record")
    for k in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if not fields.get(k):
            raise BadRecord(f"record without {k}")
    name = fields["warc-record-id"].strip("<>")
    n = _length(fields, name)
    if len(raw) != at + n + len(_END) or raw[at + n:] != _END:
        raise BadRecord(f"{name}: its content length is {n}, its frame holds {len(raw) - at}")
    block, kind = raw[at:at + n], fields["warc-type"]
    http, body = _headers(block, b"HTTP/1.", name)
    size = _length(http, name)
    digest = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    if kind == "response":
        payload = block[body:]
        if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
            raise BadRecord(f"{name}: payload and its length or digest differ")
    elif kind == "revisit":
        payload = None
        if len(block) != body or not fields.get("warc-refers-to"):
            raise BadRecord(f"{name}: a revisit holds headers and names what it refers to")
    else:
        raise BadRecord(f"{name}: type {kind!r}")
    refers = fields.get("warc-refers-to", "").strip("<>")
    return {"page_id": _page_id(name), "record_type": kind, "url": fields.get("warc-target-uri"),
            "refers_to": _page_id(refers) if refers else None, "payload_digest": digest,
            "payload_bytes": size, "payload": payload}


class ArchiveWriter:
    """Frames of one archive after another; ``names`` lists the finished ones."""

    def __init__(self, folder: str, dictionary: bytes):
        self.store, self.folder = open_store(folder)
        self.store.create_dir(self.folder, recursive=True)
        self.dictionary, self.out, self.done = dictionary, None, []
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.zstd = zstandard.ZstdCompressor(level=3, dict_data=trained, write_content_size=True)

    def write(self, record: bytes) -> None:
        if self.out is None:
            self.name = f"{self.folder.rstrip('/')}/{uuid.uuid4().hex}.warc.zst"
            self.out, self.size, self.records = self.store.open_output_stream(self.name, compression=None), 0, 0
            if self.dictionary:
                self.out.write(struct.pack("<II", _DICT_MAGIC, len(self.dictionary)) + self.dictionary)
        frame = self.zstd.compress(record)
        self.out.write(frame)
        self.size, self.records = self.size + len(frame), self.records + 1
        if self.size >= ARCHIVE_BYTES or self.records >= ARCHIVE_RECORDS:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((os.path.basename(self.name), self.records))
            self.out = None


def read_archive(stream) -> Iterator[bytes]:
    """The records of an archive, a frame each. The bytes read are walked through once, in place."""
    buffer, at, trained = b"", 0, None

    def have(n: int) -> bool:
        nonlocal buffer, at
        while len(buffer) - at < n:
            more = stream.read(_READ)
            if not more:
                return False
            buffer, at = buffer[at:] + more, 0
        return True

    first = True
    while have(1):
        if not have(4):
            raise BadRecord("the archive ends within a frame")
        magic = struct.unpack_from("<I", buffer, at)[0]
        if magic in _SKIPPABLE:
            if not have(8) or not have(8 + (n := struct.unpack_from("<I", buffer, at + 4)[0])):
                raise BadRecord("the archive ends within a skippable frame")
            if first and magic == _DICT_MAGIC:
                raw = buffer[at + 8:at + 8 + n]
                raw = zstandard.ZstdDecompressor().decompress(raw) if raw[:4] == _ZSTD_MAGIC else raw
                trained = zstandard.ZstdCompressionDict(raw)
            at, first = at + 8 + n, False
            continue
        first = False
        if buffer[at:at + 4] != _ZSTD_MAGIC:
            raise BadRecord(f"no frame starts with {buffer[at:at + 4]!r}")
        frame = zstandard.ZstdDecompressor(dict_data=trained).decompressobj()
        parts = []
        while not frame.eof:
            if not have(1):
                raise BadRecord("the archive ends within a frame")
            piece = memoryview(buffer)[at:at + _FEED]
            parts.append(frame.decompress(piece))
            at += len(piece) - (len(frame.unused_data) if frame.eof else 0)
        yield b"".join(parts)


def write_archives(pages: DataFrame, folder: str, dictionary: bytes) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, payload, payload_bytes, payload_digest,
    revisits, refers_to) below ``folder``; the staged list (archive, records) of what was written."""
    spark = pages.sparkSession
    small_batches(spark)
    shared = Shared(spark, dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = ArchiveWriter(folder, shared.value())
        for b in batches:
            for r in b.to_pylist():
                writer.write(build_record(r["page_id"], r["url"], r["payload"], r["payload_bytes"], r["payload_digest"],
                                          page_name(r["refers_to"]) if r["revisits"] else None))
        writer.close()
        yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in writer.done], pa.string()),
                                          pa.array([k for _, k in writer.done], pa.int64())], ["archive", "records"])

    return staged(pages.select("page_id", "url", "payload", "payload_bytes", "payload_digest", "revisits", "refers_to")
                  .mapInArrow(run, "archive string, records long"), "archive_list")


_FIELDS = [("archive", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("url", pa.string()),
           ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
           ("payload", pa.binary())]


def read_archives(archives: DataFrame, folder: str, payload: bool = True, tasks: int | None = None) -> DataFrame:
    """Records of the listed archives (column ``archive``) below ``folder``, checked. By default a task each,
    up to a few for each core of the cluster."""
    if tasks is None:
        tasks = max(1, min(archives.count(), 4 * archives.sparkSession.sparkContext.defaultParallelism))
    fields = _FIELDS if payload else _FIELDS[:-1]
    kinds = {pa.string(): "string", pa.int64(): "long", pa.binary(): "binary"}

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in fields],
                                          [n for n, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        for b in batches:
            for name in b.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{root.rstrip('/')}/{name}", compression=None) as stream:
                    for raw in read_archive(stream):
                        rows.append(parse_record(raw) | {"archive": name})
                        held += len(raw) if payload else 200
                        if held >= 8 << 20:
                            yield batch(rows)
                            rows, held = [], 0
                if rows:
                    yield batch(rows)

    return archives.select("archive").repartition(tasks).mapInArrow(run, ", ".join(f"{n} {kinds[t]}" for n, t in fields))


def with_types(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, revisits, refers_to) of ``pages``."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    url = F.col("url") if "url" in pages.columns else F.lit(None).cast("string")
    rows = pages.select("page_id", url.alias("url"), payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"),
                        F.sha2(payload, 256).alias("payload_digest"))
    firsts = (rows.where(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("payload_digest")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return (rows.join(staged(firsts, "same_payloads"), "payload_digest", "left")
            .withColumn("revisits", again).withColumn("refers_to", F.when(again, F.col("first"))))


def sample_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from at most ``DICT_PAGES`` pages, of each at most ``DICT_PAGE_CHARS`` characters."""
    rows = (pages.where("html is not null").select(F.substring("html", 1, DICT_PAGE_CHARS).alias("s"))
            .limit(DICT_PAGES).collect())
    return train_dictionary([r["s"].encode() for r in rows])


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives, read them back, and return what the records say, one row each."""
    folder = scratch_path(spark, "warc")
    archives = write_archives(with_types(pages), folder, sample_dictionary(pages))
    return read_archives(archives, folder, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= {REVISIT_BYTES}
      GROUP BY ALL HAVING count(*) > 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)"""
