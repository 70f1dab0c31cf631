"""Helpers shared by the operators: scratch tables, hot keys, bounded slices of Arrow batches."""

from __future__ import annotations

import atexit
import ctypes
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: White space between words in all contracts: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\f\r"

#: Parts that the rows of one key are dealt to.
SALTS = 64

#: Upper-case ASCII letters to lower case; the bytes of other characters stay.
ASCII_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share; an error where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        folder = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = folder.get() if folder.isDefined() else None
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return root.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted when the Python driver ends."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    atexit.register(_delete, spark, path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


#: Whether the shuffle files of a query go when it ends, and not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and read again after a lost executor.

    Its shuffle files are deleted when it is written, for the table takes their place.
    """
    spark = df.sparkSession
    path = path or shared_path(spark, label)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a stored table that nothing will read again."""
    _delete(spark, path)


def drop_stored(*tables: DataFrame) -> None:
    """Deletes the folders of stored tables that nothing will read again, so that rounds do not pile up on the disk."""
    for table in tables:
        files = table.inputFiles()
        if files:
            discard(table.sparkSession, files[0].rsplit("/", 1)[0])


def salt_of(*columns: Column | str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int")


def attach(rows: DataFrame, keys: list[str], salt: str, parts: dict[str, Column], merge: dict[str, Column]) -> DataFrame:
    """Each row of ``rows`` with aggregates over all rows of its key.

    ``rows`` has a column ``salt`` below ``SALTS``. A key is first folded for each
    salt (``parts``, which Spark combines before the shuffle), then over its at most
    ``SALTS`` partial rows (``merge``), and comes back once for each salt, so that no
    task gets all rows of a hot key. Keys may be NULL.
    """
    partial = rows.groupBy(*keys, salt).agg(*(c.alias(n) for n, c in parts.items()))
    whole = partial.groupBy(*keys).agg(*(c.alias(n) for n, c in merge.items()), F.collect_list(salt).alias("_salts"))
    table = whole.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), *merge,
                         F.explode("_salts").alias("_salt"))
    match = F.col(salt) == F.col("_salt")
    for i, k in enumerate(keys):
        match &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return rows.drop(*merge).join(table, match).drop("_salt", *(f"_k{i}" for i in range(len(keys))))


def give_back() -> None:
    """Returns freed memory of a worker to the system: workers live on, and what one stage needed would stay with them."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def text_slices(batches: Iterable[pa.RecordBatch], column: str, chars: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Runs of rows holding about ``chars`` characters of ``column`` (one row at least), NULL read as empty."""
    for batch in batches:
        begin = size = 0
        texts: list[str] = []
        for i, value in enumerate(batch.column(column)):
            text = value.as_py() or ""
            texts.append(text)
            size += len(text)
            if size >= chars:
                yield batch.slice(begin, i + 1 - begin), texts
                begin, size, texts = i + 1, 0, []
        if texts:
            yield batch.slice(begin), texts
    give_back()


def unused(name: str, *frames: DataFrame) -> str:
    """``name``, or a longer one, that no column of ``frames`` has: a working column that shades none."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def carried(df: DataFrame, text_col: str, keep: list[str] | None, *added: str) -> list[str]:
    """The columns that a result keeps: ``keep``, or all but the text; names in ``added`` give way."""
    return [c for c in (keep if keep is not None else df.columns) if c not in added and (keep is not None or c != text_col)]


def schema_with(df: DataFrame, columns: list[str], more: str) -> str:
    """DDL of the named columns of ``df`` followed by ``more``."""
    kept = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns]
    return ", ".join([*kept, more])


def lookup(rows: DataFrame, table: DataFrame, key: str, spread_by: str, most: int = 10_000) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row for each key, NULL included.

    A table of ``most`` rows or fewer, which is counted first, is broadcast. A larger one
    is laid out once for each salt, so that the rows of a hot key go to many tasks.
    """
    table = stored(table, "lookup")
    name, salt, part = (unused(n, rows, table) for n in ("_key", "_salt", "_own"))
    own = table.withColumnRenamed(key, name)
    match = F.col(key).eqNullSafe(F.col(name))
    if table.limit(most + 1).count() <= most:
        return rows.join(F.broadcast(own), match).drop(name)
    own = own.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn(part, salt_of(spread_by)).join(
        own, match & (F.col(part) == F.col(salt))).drop(name, part, salt)
