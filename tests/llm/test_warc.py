"""WARC: what is written can be read by plain gzip, damage is told, revisits are resolved."""

from __future__ import annotations

import gzip
import hashlib
import io
import zlib
from base64 import b32encode
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc
from tidemark.llm.common import shared_path

PAGES = "page_id long, url string, html string"
ROWS = [(1, "http://a/ b\r\nx: y", "<p>é</p>"), (2, None, None), (3, "http://c", ""), (4, "http://d", "<p>é</p>"),
        (None, "http://e", "<p>é</p>"), (5, "http://f", "WARC/1.1\r\n\r\n" * 3), (6, "http://g", "x" * 300_000), (6, "http://g", "x" * 300_000)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(ROWS, PAGES)


def _written(spark, pages, **how):
    return warc.write_pages(pages, shared_path(spark, "warc"), **how)


def test_round_trip(spark, pages):
    records = warc.read_warc(_written(spark, pages)).collect()
    assert len(records) == len(ROWS) and not any(r.error for r in records)
    by_type = Counter((r.type, r.record_id) for r in records)
    assert by_type == Counter({("response", "<urn:page:1>"): 1, ("response", "<urn:page:2>"): 1, ("revisit", "<urn:page:3>"): 1,
                               ("revisit", "<urn:page:4>"): 1, ("revisit", "<urn:page:>"): 1, ("response", "<urn:page:5>"): 1,
                               ("response", "<urn:page:6>"): 2})
    html = {f"<urn:page:{i}>": (h or "").encode() for i, _, h in ROWS}
    for r in records:
        if r.type == "response":
            assert bytes(r.payload) == html[r.record_id] and r.payload_bytes == len(r.payload)
            assert r.payload_digest == b32encode(hashlib.sha1(r.payload).digest()).decode()
    assert next(r for r in records if r.record_id == "<urn:page:1>").target_uri == "http://a/%20b%0D%0Ax:%20y"


def test_resolved(spark, pages):
    rows = warc.resolved(warc.read_warc(_written(spark, pages), keep_payload=False)).collect()
    size = {(r.type, r.record_id): r.payload_bytes for r in rows}
    assert size["revisit", "<urn:page:4>"] == size["revisit", "<urn:page:>"] == 9
    assert size["revisit", "<urn:page:3>"] == 0 and all(r.payload is None for r in rows)


@pytest.mark.parametrize("spoil", [lambda d: d[:-9], lambda d: b""])
def test_damage_fails_the_query(spark, pages, spoil):
    manifest = _written(spark, pages)
    assert warc.verified(manifest, warc.read_warc(manifest)).count() == len(ROWS)
    path = manifest.first().path.removeprefix("file:")
    with open(path, "rb") as f:
        data = f.read()
    with open(path, "wb") as f:
        f.write(spoil(data))
    with pytest.raises(ValueError, match="records read"):
        warc.verified(manifest, warc.read_warc(manifest))


def test_short_payloads_are_responses(spark, pages):
    kinds = Counter(r.type for r in warc.read_warc(_written(spark, pages, least=10)).collect())
    assert kinds == {"response": 8}


def test_archives_are_cut(spark, pages):
    manifest = _written(spark, pages.repartition(1), archive=1)
    assert manifest.agg(F.max("records")).first()[0] == 1
    assert warc.read_warc(manifest).count() == len(ROWS)


def test_plain_gzip_reads_it(spark, pages):
    for row in _written(spark, pages).collect():
        with open(row.path.removeprefix("file:"), "rb") as f:
            data = f.read()
        assert len(data) == row.bytes
        assert gzip.decompress(data).count(b"WARC-Record-ID: ") == row.records


def _archive():
    return [warc.page_record(i, f"http://x/{i}", b"payload %d " % i * 9000, None, "2024-01-01T00:00:00Z", 6) for i in range(4)]


def _read(data, **how):
    return list(warc.read_records(io.BytesIO(data), **how))


def test_every_cut_is_told():
    parts = _archive()
    data = b"".join(parts)
    edges = {sum(map(len, parts[:k])): k for k in range(5)}
    for cut in range(1, len(data), 37):
        rows = _read(data[:cut])
        whole = max(k for at, k in edges.items() if at <= cut)
        assert [r["error"] for r in rows[:whole]] == [None] * whole
        assert len(rows) == whole + (cut not in edges) and (cut in edges or rows[-1]["error"].startswith("damaged"))


def test_offsets_name_the_members():
    parts = _archive()
    data = b"".join(parts)
    for row in _read(data):
        one = zlib.decompressobj(31).decompress(data[row["offset"]:])
        assert row["record_id"].encode() in one and one.count(b"WARC/1.1") == 1


@pytest.mark.parametrize("change, error", [
    (lambda b: b.replace(b"payload 1", b"PAYLOAD 1", 1), "block digest, payload digest"),
    (lambda b: b.replace(b"Content-Length: ", b"Content-Length: 9", 1), "damaged"),
    (lambda b: b + b"more", "damaged"),
    (lambda b: b.replace(b"WARC/1.1", b"HTTP/1.1", 1), "damaged"),
    (lambda b: b"no header at all", "damaged"),
])
def test_wrong_records(change, error):
    parts = _archive()
    parts[1] = gzip.compress(change(gzip.decompress(parts[1])))
    rows = _read(b"".join(parts))
    assert rows[0]["error"] is None and rows[1]["error"].startswith(error)
    assert len(rows) == (2 if error == "damaged" else 4)


def test_payload_is_optional():
    assert all(r["payload"] is None and r["payload_bytes"] > 80_000 for r in _read(b"".join(_archive()), keep_payload=False))


def test_empty(spark):
    none = spark.createDataFrame([], PAGES)
    manifest = _written(spark, none)
    assert manifest.count() == 0 and warc.read_warc(manifest).count() == 0
    assert _read(b"") == []


def test_archives_are_read_by_a_task_each(spark, pages):
    manifest = _written(spark, pages, archive=1)
    archives = manifest.count()
    assert archives == len(ROWS)
    records = warc.read_warc(manifest)
    assert records.rdd.getNumPartitions() == archives and records.count() == len(ROWS)
