"""WARC records in seekable Zstandard bundles.

Every page becomes one WARC 1.1 record. Of pages with equal payloads of at least ``LEAST_BYTES``
bytes the one with the smallest id is the response; the others are revisit records that name it and
carry no payload. Records are gathered into independent Zstandard frames of about ``FRAME_BYTES``;
a bundle is such frames, a skippable frame with the record index (record id to frame, offset in the
frame, length), and the seek table of the seekable format as its footer. ``Bundle`` reads the footer
and decompresses only the frame that holds a record.

Scale: the smallest id per payload is an aggregate over digests (summed per task first); only
digests that occur twice are written and joined back, so a payload that a third of all pages share
is one row there, and the page side of that join is a plain exchange that adaptive execution splits.
Each task writes its own bundles of at most about ``BUNDLE_BYTES`` of records, in page order, under
names made of its partition, moved into place when whole: a task that is run again leaves the same
files. Bundles are listed in a table, never on the driver.

Defined cases: null html is an empty payload; a null page id gives a record named ``null`` that is
never referred to unless every page of the payload has one (then all are responses); rows that
repeat the response's id are responses too; an empty table writes no bundle; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import pieces, put_file, shared_uri, slices, table
from revlens.session import written

LEAST_BYTES, FRAME_BYTES, BUNDLE_BYTES = 100, 256 << 10, 32 << 20
#: Archive bytes that a task reads back.
READ_BYTES = 4 << 20
# FIXED VALUES: numbers of the Zstandard seekable format, and of the skippable frame for the index.
SEEK_FRAME, INDEX_FRAME, SEEK_MAGIC = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1
DATE = "2024-01-01T00:00:00Z"  # records carry a fixed date: equal input gives equal files
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: int | None) -> str:
    return f"urn:page:{'null' if page_id is None else page_id}"


def page_of(name: str) -> int | None:
    own = name.strip("<>").removeprefix("urn:page:")
    return None if own == "null" else int(own)


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record: a response with its payload, or a revisit (``refers_to`` given) without."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <{record_id(page_id)}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{record_id(refers_to)}>", f"WARC-Profile: {PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join([*head, "", ""]).encode("utf-8") + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields of one record; the payload of a response is checked against its digest."""
    end = raw.index(b"\r\n\r\n")
    first, *lines = raw[:end].decode("utf-8").split("\r\n")
    if first != "WARC/1.1":
        raise ValueError("not a WARC record")
    head = dict(x.split(": ", 1) for x in lines)
    block = raw[end + 4:end + 4 + int(head["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
    if head["WARC-Type"] == "response" and (len(payload), hashlib.sha256(payload).hexdigest()) != (size, digest):
        raise ValueError(f"damaged record {head['WARC-Record-ID']}")
    refers = head.get("WARC-Refers-To")
    return {"page_id": page_of(head["WARC-Record-ID"]), "url": head.get("WARC-Target-URI"), "payload_bytes": size,
            "payload_digest": digest, "record_type": head["WARC-Type"], "refers_to": page_of(refers) if refers else None,
            "payload": payload}


class BundleWriter:
    """Collects records into frames; ``finish`` gives the bytes of the bundle."""

    def __init__(self, frame_bytes: int = FRAME_BYTES):
        import zstandard

        self.pack = zstandard.ZstdCompressor(level=3).compress
        self.frame_bytes = frame_bytes
        self.frames: list[tuple[bytes, int]] = []
        self.open: list[bytes] = []
        self.size = self.held = 0
        self.index: list[tuple[str, int, int, int]] = []

    def add(self, name: str, record: bytes) -> None:
        self.index.append((name, len(self.frames), self.held, len(record)))
        self.open.append(record)
        self.held += len(record)
        self.size += len(record)
        if self.held >= self.frame_bytes:
            self._close()

    def _close(self) -> None:
        if self.open:
            self.frames.append((self.pack(b"".join(self.open)), self.held))
            self.open, self.held = [], 0

    def finish(self) -> bytes:
        self._close()
        index = self.pack(json.dumps(self.index).encode())
        index = struct.pack("<II", INDEX_FRAME, len(index)) + index
        entries = [*((len(c), n) for c, n in self.frames), (len(index), 0)]
        seek = b"".join(struct.pack("<II", *e) for e in entries)
        footer = struct.pack("<IBI", len(entries), 0, SEEK_MAGIC)
        return b"".join([*(c for c, _ in self.frames), index, struct.pack("<II", SEEK_FRAME, len(seek) + len(footer)),
                         seek, footer])


class Bundle:
    """Reads a bundle through ``read_at(offset, length)``."""

    def __init__(self, size: int, read_at):
        import zstandard

        self.read_at, self.unpack = read_at, zstandard.ZstdDecompressor().decompress
        frames, flags, magic = struct.unpack("<IBI", read_at(size - 9, 9))
        if magic != SEEK_MAGIC or flags:
            raise ValueError("no seek table")
        table_ = read_at(size - 9 - 8 * frames, 8 * frames)
        self.frames, at = [], 0
        for i in range(frames):
            n, _ = struct.unpack_from("<II", table_, 8 * i)
            self.frames.append((at, n))
            at += n
        at, n = self.frames.pop()
        self.index = [tuple(x) for x in json.loads(self.unpack(read_at(at + 8, n - 8)))]
        self.places: dict[str, list[tuple[int, int, int]]] | None = None

    def frame(self, k: int) -> bytes:
        return self.unpack(self.read_at(*self.frames[k]))

    def records(self) -> Iterator[bytes]:
        held, k = b"", -1
        for _, frame, at, n in self.index:
            if frame != k:
                held, k = self.frame(frame), frame
            yield held[at:at + n]

    def find(self, name: str) -> list[bytes]:
        """Records of that id; only their frames are decompressed."""
        if self.places is None:
            self.places = {}
            for own, k, at, n in self.index:
                self.places.setdefault(own, []).append((k, at, n))
        return [self.frame(k)[at:at + n] for k, at, n in self.places.get(name, [])]


def with_responses(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page_id, url, html, digest, refers_to): refers_to is null for a response."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    shared = (rows.filter(F.octet_length("html") >= least_bytes).groupBy("digest")
              .agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first")).filter("n > 1 and first is not null"))
    shared = written(shared.select("digest", "first"), "warc-shared")
    own = F.col("first").isNull() | F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(shared, "digest", "left").select(
        "page_id", "url", "html", "digest", F.when(~own, F.col("first")).alias("refers_to"))


def write_bundles(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES, frame_bytes: int = FRAME_BYTES,
                  bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write (page_id, url, html) as bundles in ``folder`` (a URI); table (name, bytes, records) of them."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, done = BundleWriter(frame_bytes), []
        place = TaskContext.get().partitionId()

        def close() -> None:
            raw = bundle.finish()
            name = f"part-{place:08d}-{len(done):05d}.warc.zst"
            put_file(folder, name, raw)
            done.append((name, len(raw), len(bundle.index)))

        for part in slices(batches, "html"):
            for page, url, html, digest, refers in zip(*(c.to_pylist() for c in part.columns), strict=True):
                bundle.add(record_id(page), make_record(page, url, html.encode("utf-8"), digest, refers))
                if bundle.size >= bundle_bytes:
                    close()
                    bundle = BundleWriter(frame_bytes)
        if bundle.index:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in
                                          enumerate((pa.string(), pa.int64(), pa.int64()))], ["name", "bytes", "records"])

    rows = with_responses(pages, least_bytes).sortWithinPartitions("page_id", "digest", "url")
    return written(rows.mapInArrow(write, "name string, bytes bigint, records bigint"), "warc-bundles")


def read_bundles(bundles: DataFrame, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url) of every record in the files."""
    fields = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
              "record_type": pa.string(), "refers_to": pa.int64(), "url": pa.string()}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_input_file(f"{base}/{name}") as f:
                    rows = []
                    for raw in Bundle(size, lambda at, n, f=f: f.read_at(n, at)).records():
                        row = parse_record(raw)
                        rows.append([row[k] for k in fields])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], t) for i, t in enumerate(fields.values())], list(fields))

    # as many tasks as the archives' bytes ask for: a list of names alone would be put into one
    total = bundles.agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("size")).first()
    spread = bundles.select("name", "bytes").repartition(max(1, min(total["n"], pieces(total["size"], READ_BYTES))), "name")
    return spread.mapInArrow(read, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
                                   "refers_to bigint, url string")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives of all pages hold, read back from the bundles."""
    folder = shared_uri(spark, "warc")
    read = read_bundles(write_bundles(table(spark, sf_dir, "pages"), folder), folder)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS payload_digest FROM pages),
q AS (SELECT *, octet_length(encode(html)) AS payload_bytes,
             min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM q
"""
