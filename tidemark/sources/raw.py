"""Raw landing zone: gzip files of JSON lines under ``dt=YYYY-MM-DD/``.

A file holds one hour, named ``H.json.gz`` or kept in an ``hour=H`` folder. It is
opened once, as a stream, by the task that unpacks it: the lines come first and the
verdict on the file last, for only its end tells whether it is whole. So lines must be
set aside until the verdict is known. Read errors of the storage are not mistaken for
damage but fail and retry the task.
"""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterable, Iterator
from contextlib import closing

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions import schemas
from tidemark.sources.files import STREAMED, open_file, scheme_of

_PIECE = 1 << 20
_DAMAGE = (EOFError, gzip.BadGzipFile, zlib.error)

FILE_CHECK = "path string, dt date, hour int, length long, modificationTime timestamp, ok boolean, error string, line_cnt long, text_bytes long"
#: A line, or after a file's last line its verdict.
UNPACKED = ("path string, dt date, hour int, length long, modificationTime timestamp, line string, done boolean, "
            "error string, line_cnt long, text_bytes long")
_OF_FILE = ("path", "dt", "hour", "length", "modificationTime")


def raw_files(spark: SparkSession, raw_root: str, days: list | None = None) -> DataFrame:
    """``path, dt, hour, length, modificationTime, content`` of all files or those of some days' folders.

    From the listing alone; the content is NULL where tasks can open the files themselves.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").option("basePath", raw_root)
    root = raw_root.rstrip("/")
    files = reader.load(raw_root if days is None else [f"{root}/dt={day}" for day in days])
    hour = F.col("hour") if "hour" in files.columns else F.regexp_extract("path", r"/(\d{1,2})\.json\.gz$", 1)
    path = spark._jvm.org.apache.hadoop.fs.Path(raw_root)
    scheme = scheme_of(raw_root) or path.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme()
    content = F.lit(None).cast("binary").alias("content") if scheme in STREAMED else "content"
    return files.select("path", F.col("dt").cast("date").alias("dt"), hour.cast("int").alias("hour"),
                        "length", "modificationTime", content)


def unpacked(files: DataFrame) -> DataFrame:
    """The lines of every file, and after them a row with ``done``: the error of a damaged file, lines and unpacked size."""
    return files.select(*_OF_FILE, "content").mapInArrow(_unpack_files, UNPACKED)


def gzip_integrity(files: DataFrame) -> DataFrame:
    """One row per file: whether it unpacks to its end, and its lines and unpacked size."""
    return files.select(*_OF_FILE, "content").mapInArrow(_check_files, FILE_CHECK)


class _File:
    """One file: its unpacked pieces, and once they are used up the verdict."""

    def __init__(self, row: pa.RecordBatch):
        self.row = row
        self.error: str | None = None
        self.lines = self.size = 0

    def pieces(self) -> Iterator[bytes]:
        """No piece ends between the two characters of a line end. A damaged file ends early."""
        content = self.row.column("content")[0]
        source = pa.BufferReader(content.as_buffer()) if content.is_valid else open_file(self.row.column("path")[0].as_py())
        last = b"\n"
        try:
            with closing(source), gzip.GzipFile(fileobj=source) as plain:
                while piece := plain.read(_PIECE):
                    while piece.endswith(b"\r") and (more := plain.read(_PIECE)):
                        piece += more
                    self.lines += piece.count(b"\n") + piece.count(b"\r") - piece.count(b"\r\n")
                    self.size += len(piece)
                    last = piece[-1:]
                    yield piece
        except _DAMAGE as error:
            self.error, self.lines, self.size = f"{type(error).__name__}: {error}", 0, 0
        else:
            self.lines += last not in b"\r\n"


def _lines(pieces: Iterable[bytes]) -> Iterator[pa.Array]:
    """Lines without their ends (of any kind), some at a time."""
    rest: list[bytes] = []
    for piece in pieces:
        cut = max(piece.rfind(b"\n"), piece.rfind(b"\r")) + 1
        if cut:
            yield _split(b"".join([*rest, piece[:cut]]))
            rest = []
        rest.append(piece[cut:])
    if any(rest):
        yield _split(b"".join(rest))


def _split(block: bytes) -> pa.Array:
    text = block.replace(b"\r\n", b"\n").replace(b"\r", b"\n").removesuffix(b"\n").decode("utf-8", "replace")
    return pc.split_pattern(pa.array([text], pa.large_string()), "\n").flatten().cast(pa.string())


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[_File]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield _File(batch.slice(i, 1))


def _check_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for file in _files(batches):
        for _ in file.pieces():
            pass
        yield pa.RecordBatch.from_arrays(
            [*(file.row.column(name) for name in _OF_FILE), pa.array([file.error is None]), pa.array([file.error], pa.string()),
             pa.array([file.lines]), pa.array([file.size])], names=[field.split()[0] for field in FILE_CHECK.split(", ")])


def _unpack_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in UNPACKED.split(", ")]

    def batch(file: _File, lines: pa.Array, done: bool) -> pa.RecordBatch:
        n = len(lines)
        same = lambda value, kind: pa.repeat(pa.scalar(value, kind), n)
        return pa.RecordBatch.from_arrays(
            [*(pa.repeat(file.row.column(name)[0], n) for name in _OF_FILE), lines, same(done, pa.bool_()),
             same(file.error, pa.string()), same(file.lines if done else None, pa.int64()),
             same(file.size if done else None, pa.int64())], names=names)

    for file in _files(batches):
        for lines in _lines(file.pieces()):
            yield batch(file, lines, False)
        yield batch(file, pa.nulls(1, pa.string()), True)


def parse_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Replace the line by ``event``, its envelope, NULL for a bad line.

    A line is good when it is one JSON object of the envelope's shape and
    nothing else. Spark stops reading at the end of the first value, so the line
    is set into a frame that ends with the line's own hash, which no line can
    hold: the value that Spark reads has to reach the frame's end. A line that
    closes the array itself has to open a further key to get there, and shows by
    the number of keys.
    """
    mark = F.sha2(F.col(line).cast("binary"), 256)
    text = F.concat(F.lit('{"lines":['), F.col(line), F.lit('],"end":"'), mark, F.lit('"}'))
    shape = f"lines array<{schemas.ENVELOPE.simpleString()}>, end string, _bad string"
    options = {"columnNameOfCorruptRecord": "_bad", "allowSingleQuotes": "false"}
    good = ((F.size("_frame.lines") == 1) & (F.col("_frame.end") == mark) & F.col("_frame._bad").isNull()
            & (F.size(F.json_object_keys(text)) == 2))
    parsed = lines.withColumn("_frame", F.from_json(text, shape, options))
    # A generator, not a projection: a later filter on the event stays above it
    # instead of being moved down as a second parse.
    event = F.explode_outer(F.when(good, F.col("_frame.lines"))).alias("event")
    return parsed.select(*[c for c in lines.columns if c != line], event)


def ods_rows(parsed: DataFrame, *more: Column) -> DataFrame:
    """Landed rows of the good lines: missing texts become '' except the organisation's, missing ids stay NULL.

    ``more`` are further columns of ``parsed`` to keep.
    """
    return _landed(parsed.filter(F.col("event").isNotNull()), *more)


def file_key(path: str) -> Column:
    """The name of a raw file's folder in the landed table."""
    return F.concat(F.lit("f"), F.sha1(path))


def staged_rows(parsed: DataFrame) -> DataFrame:
    """Landed rows with the file they come from, and the rows with the files' verdicts."""
    path = F.col("path")
    return _landed(parsed.filter(F.col("event").isNotNull() | F.col("done")), path.alias("raw_path"), file_key("path").alias("file"),
                   "length", "modificationTime", "done", "error", "line_cnt", "text_bytes")


def _landed(parsed: DataFrame, *more: Column | str) -> DataFrame:
    def text(path: str, name: str):
        return F.coalesce(f"event.{path}", F.lit("")).alias(name)

    return parsed.select(
        text("id", "event_id"),
        text("type", "event_type"),
        F.col("event.actor.id").alias("actor_id"),
        text("actor.login", "actor_login"),
        F.col("event.repo.id").alias("repo_id"),
        text("repo.name", "repo_name"),
        F.col("event.org.id").alias("org_id"),
        F.col("event.org.login").alias("org_login"),
        text("created_at", "created_at"),
        F.col("event.public").alias("is_public"),
        F.col("event.payload").alias("payload"),
        *more, "dt", "hour",
    )


def bad_line_report(parsed: DataFrame, *by: str) -> DataFrame:
    """Lines and bad lines (blank, broken or not an object) per group."""
    return parsed.groupBy(*by).agg(
        F.count("*").alias("line_cnt"), F.count_if(F.col("event").isNull()).alias("bad_cnt"))
