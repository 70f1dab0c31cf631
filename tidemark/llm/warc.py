"""WARC archives: one gzip member per record, written and read sequentially.

Files are opened by the tasks through pyarrow's file systems, so that an archive is
never held as a whole. What a write leaves behind is known from its manifest: a file of
an attempt that failed is not in it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import attach, salt_of, shared_path, stored

#: Bytes of an archive after which the next one begins, and bytes read at a time.
ARCHIVE, CHUNK = 256 << 20, 64 << 10

#: Payload bytes that the rows of one batch hold together before it is handed over.
BATCH = 4 << 20

#: Tasks that read archives, where there are as many.
READERS = 20_000

#: Longest header block of a record.
HEADER = 1 << 20

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = ("path string, offset long, type string, record_id string, target_uri string, refers_to string, "
           "payload_digest string, payload_bytes long, payload binary, error string")
_FIELDS = [f.split()[0] for f in RECORDS.split(", ")]


def digest_of(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(fields: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields)
    head = f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode()
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress(head + block + b"\r\n\r\n") + pack.flush()


def _http(payload: bytes) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)


def page_record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str, level: int) -> bytes:
    """A response, or a revisit that names the response with the same payload and has no payload itself."""
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    # Characters that would end the header line are escaped.
    uri = quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else f"urn:page:{page}"
    fields = [("WARC-Record-ID", name(page)), ("WARC-Date", date), ("WARC-Target-URI", uri),
              ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}")]
    if refers_to is None:
        block = _http(payload) + payload
        return _record([("WARC-Type", "response"), *fields, ("WARC-Block-Digest", f"sha1:{digest_of(block)}")], block, level)
    block = _http(payload)
    return _record([("WARC-Type", "revisit"), *fields, ("WARC-Block-Digest", f"sha1:{digest_of(block)}"),
                    ("WARC-Profile", PROFILE), ("WARC-Refers-To", name(refers_to))], block, level)


def write_pages(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                least: int = 0, date: str = "2024-01-01T00:00:00Z", level: int = 6, archive: int = ARCHIVE) -> DataFrame:
    """Writes a record per row under ``folder``; the manifest (path, records, bytes).

    Of equal payloads of ``least`` bytes or more the row with the smallest id is the
    response and others revisit it; ids that are NULL come last, and rows that share
    the smallest id are all responses. A NULL payload is an empty one. An empty table
    writes nothing.
    """
    html = F.coalesce(html_col, F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).alias("url"), html.alias("html"),
                        F.sha1(html).alias("sha1")).withColumn("salt", salt_of("page", "url"))
    first = F.min(F.struct(F.col("page").isNull().alias("n"), F.col("page").alias("page")))
    rows = attach(rows, ["sha1"], "salt", {"f": first}, {"first": F.min("f")})
    again = (F.octet_length("html") >= least) & ~F.col("page").eqNullSafe(F.col("first.page"))
    rows = rows.select("page", "url", "html", F.when(again, F.col("first.page")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        files.create_dir(root)
        task = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:12]}"
        done, out, name = [], None, ""
        records = size = 0
        for batch in batches:
            for i in range(batch.num_rows):
                page, url, text, refers_to = (batch.column(c)[i].as_py() for c in ("page", "url", "html", "refers_to"))
                if out is None:
                    name, records, size = f"{task}-{len(done):04d}.warc.gz", 0, 0
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                data = page_record(page, url, text.encode(), refers_to, date, level)
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= archive:
                    out.close()
                    done.append((f"{folder}/{name}", records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", records, size))
        if done:
            path, count, total = zip(*done)
            yield pa.RecordBatch.from_arrays(
                [pa.array(path), pa.array(count, pa.int64()), pa.array(total, pa.int64())], ["path", "records", "bytes"])

    return stored(rows.mapInArrow(run, "path string, records long, bytes long"), "manifest")


class _Members:
    """The gzip members of a stream one after another, each unpacked as it is asked for."""

    def __init__(self, stream) -> None:
        self.stream, self.raw, self.offset = stream, b"", 0  # of the member that is next or open

    def open(self) -> bool:
        self.raw = self.raw or self.stream.read(CHUNK)
        self.unpack, self.text, self.packed = zlib.decompressobj(31), b"", 0
        return bool(self.raw)

    def _more(self) -> bool:
        """Unpacks a little more of the open member; false at its end."""
        if self.unpack.eof:
            return False
        if not self.raw:
            self.raw = self.stream.read(CHUNK)
            if not self.raw:
                raise EOFError("the archive ends within a record")
        before = len(self.raw)
        self.text += self.unpack.decompress(self.raw, CHUNK)
        self.raw = self.unpack.unused_data if self.unpack.eof else self.unpack.unconsumed_tail
        self.packed += before - len(self.raw)
        return True

    def header(self) -> bytes:
        while (end := self.text.find(b"\r\n\r\n")) < 0:
            if len(self.text) > HEADER or not self._more():
                raise ValueError("no end of the header")
        head, self.text = self.text[:end], self.text[end + 4:]
        return head

    def body(self, length: int) -> Iterator[bytes]:
        """The next ``length`` bytes of the member, in pieces."""
        while length:
            if not self.text and not self._more():
                raise ValueError("the record is shorter than its Content-Length")
            piece, self.text = self.text[:length], self.text[length:]
            length -= len(piece)
            if piece:
                yield piece

    def close(self) -> None:
        """The member has to end with the two line ends of the record."""
        while self._more():
            if len(self.text) > 4:
                break
        if self.text != b"\r\n\r\n" or not self.unpack.eof:
            raise ValueError("the record is longer than its Content-Length")
        self.offset += self.packed


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


def read_records(stream, keep_payload: bool = True) -> Iterator[dict]:
    """The records of an archive in order. Damage ends the archive: its last row tells where and why.

    ``payload`` is what follows the HTTP header of a response. Its digest, and that of
    the block, are computed while it is read; a record whose digests differ from its
    header's is returned with ``error`` set.
    """
    members = _Members(stream)
    while members.open():
        row = dict.fromkeys(_FIELDS) | {"offset": members.offset}
        try:
            head = members.header()
            if not head.startswith(b"WARC/"):
                raise ValueError("not a WARC record")
            fields = _headers(head)
            row |= {"type": fields.get("warc-type"), "record_id": fields.get("warc-record-id"),
                    "target_uri": fields.get("warc-target-uri"), "refers_to": fields.get("warc-refers-to"),
                    "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None}
            length = int(fields.get("content-length", ""))
            if length < 0:
                raise ValueError("a negative Content-Length")
            block, payload = hashlib.sha1(), hashlib.sha1()
            web = fields.get("content-type", "").startswith("application/http")
            head_part, kept, size, in_payload = b"", [], 0, not web
            for piece in members.body(length):
                block.update(piece)
                if not in_payload:
                    head_part += piece
                    if (end := head_part.find(b"\r\n\r\n")) < 0:
                        if len(head_part) > HEADER:
                            raise ValueError("no end of the HTTP header")
                        continue
                    piece, in_payload = head_part[end + 4:], True
                payload.update(piece)
                size += len(piece)
                if keep_payload:
                    kept.append(piece)
            members.close()
        except (ValueError, EOFError, zlib.error) as damage:
            yield row | {"error": f"damaged: {damage}"}
            return
        wrong = []
        if (told := fields.get("warc-block-digest", "").removeprefix("sha1:")) and told != _b32(block):
            wrong.append("block digest")
        if row["type"] != "revisit":
            row |= {"payload_bytes": size, "payload": b"".join(kept) if keep_payload else None}
            if row["payload_digest"] not in (None, _b32(payload)):
                wrong.append("payload digest")
        yield row | {"error": ", ".join(wrong) or None}


def _b32(digest) -> str:
    return base64.b32encode(digest.digest()).decode()


def read_warc(paths: DataFrame, path_col: str = "path", keep_payload: bool = True) -> DataFrame:
    """The records of all archives in ``paths``, as ``RECORDS``; an archive is read by one task, and there are
    as many tasks as archives.

    Rows of paths that are NULL are passed over. ``payload`` is NULL for revisits and
    where ``keep_payload`` is false.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                files, name = pafs.FileSystem.from_uri(path)
                rows, size = [], 0
                with files.open_input_stream(name, compression=None) as stream:
                    for row in read_records(stream, keep_payload):
                        rows.append(row | {"path": path})
                        size += len(row["payload"] or b"") + 500
                        if size >= BATCH:
                            yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _SCHEMA)

    own = paths.select(F.col(path_col).alias("path")).filter("path IS NOT NULL")
    # Paths are a few bytes, so without a number adaptive execution would deal them all to one task.
    return own.repartition(max(1, min(READERS, own.count())), "path").mapInArrow(run, RECORDS)


_SCHEMA = pa.schema([(f.split()[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[f.split()[1]])
                     for f in RECORDS.split(", ")])


def verified(manifest: DataFrame, records: DataFrame) -> DataFrame:
    """``records``; an error where one is damaged or has a wrong digest, or where an archive lacks one."""
    told = records.groupBy("path").agg(F.count("*").alias("_read"), F.max("error").alias("_error"))
    wrong = manifest.select("path", "records").join(told, "path", "left").filter(
        "_error IS NOT NULL OR coalesce(_read, 0) <> records").first()
    if wrong:
        raise ValueError(f"{wrong.path}: {wrong._read or 0} of {wrong.records} records read, {wrong._error}")
    return records


def resolved(records: DataFrame) -> DataFrame:
    """Revisits with the ``payload_bytes`` of the response they refer to."""
    target = F.coalesce("refers_to", "record_id")
    rows = records.withColumn("_target", target).withColumn("_salt0", salt_of("record_id", "path"))
    size = F.max(F.when(F.col("type") == "response", F.col("payload_bytes")))
    rows = attach(rows, ["_target"], "_salt0", {"b": size}, {"_bytes": F.max("b")})
    return rows.withColumn("payload_bytes", F.coalesce("payload_bytes", "_bytes")).drop("_target", "_salt0", "_bytes")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"), shared_path(spark, "warc"))
    records = verified(manifest, stored(read_warc(manifest, keep_payload=False), "records"))
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    return resolved(records).select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
        number("refers_to").alias("refers_to"))


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                ((CAST('0x' || substr(h, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - i % 4 * 5 AS INTEGER)) & 31) + 1, 1)), '')
         AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""
