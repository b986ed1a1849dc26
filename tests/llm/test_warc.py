import hashlib

import pytest
import zstandard
from pyarrow import fs

from revlens.llm import warc_bundles as W
from revlens.llm.common import shared_uri

BIG = "<p>é" + "x" * 120


def plain(pages):
    first = {}
    for i, _, html in pages:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, _, html in pages:
        raw = (html or "").encode()
        r = first.get(html or "")
        revisit = len(raw) >= 100 and r is not None and i != r
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", r if revisit else None))
    return sorted(out, key=str)


def test_round_trip_and_edge_rows(spark):
    pages = [(5, "http://a", BIG), (3, None, BIG), (9, "u\r\nx", BIG), (1, "b", "short"), (2, "b", "short"), (4, "c", None),
             (None, "d", BIG), (None, "e", BIG + "2"), (None, "e", BIG + "2"), (7, "f", BIG + "3"), (7, "f", BIG + "3")]
    df = spark.createDataFrame([(*p, 0) for p in pages], "page_id bigint, url string, html string, digest int")
    folder = shared_uri(spark, "test-warc")
    bundles = W.write_bundles(df, folder, frame_bytes=300, bundle_bytes=700)
    got = W.read_bundles(bundles, folder).drop("url").collect()
    assert sorted(map(tuple, got), key=str) == plain(pages)
    assert bundles.count() > 1
    store, base = fs.FileSystem.from_uri(folder)
    for b in bundles.collect():
        raw = store.open_input_file(f"{base}/{b.name}").read()
        assert len(raw) == b.bytes
        seen = []
        bundle = W.Bundle(len(raw), lambda at, n, raw=raw: seen.append((at, n)) or raw[at:at + n])
        whole = b"".join(bundle.frame(k) for k in range(len(bundle.frames)))
        # any reader that skips skippable frames sees the same stream
        assert zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read() == whole
        for name, k, at, n in bundle.index:
            seen.clear()
            assert bundle.frame(k)[at:at + n] in bundle.find(name)
            assert (0, len(raw)) not in seen


def test_damage_and_empty(spark):
    record = W.make_record(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None)
    assert W.parse_record(record)["payload"] == b"payload"
    with pytest.raises(ValueError):
        W.parse_record(record.replace(b"payload\r\n\r\n", b"pay1oad\r\n\r\n"))
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    folder = shared_uri(spark, "test-warc")
    assert W.read_bundles(W.write_bundles(empty, folder), folder).count() == 0


def test_op8_on_the_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html").collect()
    got = W.op8_warc(spark, "/root/testdata/sf0.01").collect()
    assert sorted(map(tuple, got), key=str) == plain([tuple(r) for r in rows])
