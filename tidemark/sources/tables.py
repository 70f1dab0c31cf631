"""Partitioned tables, their listings and the view catalog."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.session import delete

#: Tables of a warehouse folder: layer and name.
LAYOUT = [
    ("ods", "events"),
    ("dwd", "event_fact"), ("dwd", "dim_repo"), ("dwd", "dim_actor"), ("dwd", "dim_date"),
    ("ads", "daily_event_type"), ("ads", "daily_repo_rank"), ("ads", "daily_actor_active"),
    ("ads", "daily_org_rank"), ("ads", "hourly_activity"), ("ads", "daily_pr_funnel"),
    ("serving", "summary"), ("serving", "meta"),
]

#: Tables that rollups and dimensions are made from, kept by day and not shown as views.
STATE = [("state", "event_grain"), ("state", "repo_days"), ("state", "actor_days"), ("state", "distinct_days"),
         ("state", "sketch_days")]

#: The day column of each table that has days.
DAY_COLUMNS = {("dwd", "event_fact"): "dt", ("serving", "summary"): "date",
               **{table: "dt" for table in STATE}, **{table: "date" for table in LAYOUT if table[0] == "ads"}}

#: What an error's condition is called where a table is not there, or holds no file yet.
ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def table_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def stored_files(spark: SparkSession, path: str) -> DataFrame | None:
    """Data files of a table with length and partition columns, from the listing alone; None if there are none."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    except AnalysisException as error:
        if error.getCondition() in ABSENT:
            return None
        raise
    return files.drop("content")


def stored_partitions(spark: SparkSession, path: str, *columns: str) -> DataFrame | None:
    """Distinct partition values present in a table, None where it has none."""
    files = stored_files(spark, path)
    if files is None or not set(columns) <= set(files.columns):
        return None
    return files.select(*columns).distinct()


def day_prints(spark: SparkSession, path: str, day: str = "dt") -> dict[str, str]:
    """What each day of a table is made of: its number of data files and a hash of their names, which never come twice.

    From the listing alone, so it is to be taken before the table is read: files that come later are then in
    the next print, whatever the clocks say. One entry per calendar day.
    """
    files = stored_files(spark, path)
    if files is None or day not in files.columns:
        return {}
    own = F.concat_ws("/", F.slice(F.split("path", "/"), -4, 4))
    prints = files.groupBy(F.col(day).alias("day")).agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64(own)).alias("x"))
    return {str(r.day): f"{r.n}:{r.x}" for r in prints.collect()}


_BUILT = "day string, source string"


def built_from(spark: SparkSession, path: str) -> dict[str, str]:
    """The prints that the days of a table were built from, as noted beside it."""
    if stored_files(spark, f"{path.rstrip('/')}_built") is None:
        return {}
    return {r.day: r.source for r in spark.read.schema(_BUILT).parquet(f"{path.rstrip('/')}_built").collect()}


def note_built(spark: SparkSession, path: str, prints: dict[str, str]) -> None:
    known = built_from(spark, path) | prints
    spark.createDataFrame(sorted(known.items()), _BUILT).coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}_built")


def on_days(table: DataFrame, days: list, column: str = "dt") -> DataFrame:
    """Rows of the given days; on a partition column the other days stay unread."""
    return table.filter(F.col(column).isin([F.lit(str(d)).cast("date") for d in days]))


def table_size(spark: SparkSession, path: str) -> DataFrame:
    """Rows (from the file footers), files and bytes of a stored table."""
    rows = spark.read.parquet(path).agg(F.count("*").alias("rows"))
    files = stored_files(spark, path).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    return rows.select("rows", *[files.select(c).scalar().alias(c) for c in ("files", "bytes")])


def write_table(df: DataFrame, path: str) -> None:
    """Replace a table; the number of files follows its size, one for a small table."""
    df.hint("rebalance").write.mode("overwrite").option("compression", "zstd").parquet(path)


def _first_files(spark: SparkSession, path: str, partitions: tuple[str, ...], asked: set[tuple]) -> dict[tuple, str]:
    """A file of each stored partition among ``asked``; file names never come twice."""
    files = stored_files(spark, path)
    if files is None or not asked or not set(partitions) <= set(files.columns):
        return {}
    days = sorted({str(values[0]) for values in asked})
    found = on_days(files, days, partitions[0]).groupBy(*partitions).agg(F.min("path").alias("path")).collect()
    return {key: r.path for r in found if (key := tuple(r[c] for c in partitions)) in asked}


def write_days(df: DataFrame, path: str, *partitions: str, rebalance: bool = True, asked: set[tuple] = frozenset()) -> None:
    """Replace the partitions present in ``df`` and those ``asked`` for, and leave the others.

    ``asked`` holds values of the partition columns, a date first; what ``df`` has no
    row for is deleted after the write. One entry per calendar day or hour. Rebalancing gathers each partition in few tasks and cuts a large one into
    several, so neither many small files nor one long task results.
    """
    spark = df.sparkSession
    before = _first_files(spark, path, partitions, asked)
    df = df.hint("rebalance", *partitions) if rebalance else df
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
     .partitionBy(*partitions).parquet(path))
    after = _first_files(spark, path, partitions, set(before))
    for key, first in before.items():
        if after.get(key) == first:
            delete(spark, first.rsplit("/", 1)[0])


def export_sample(df: DataFrame, path: str, *columns: str, rows: int = 1000) -> None:
    """A few columns of the first rows, as a file to look at."""
    df.select(*columns).limit(rows).write.mode("overwrite").parquet(path)


def view_name(layer: str, name: str) -> str:
    return f"{layer}_{name}"


def list_views(spark: SparkSession) -> DataFrame:
    """Registered views of all layers as ``(layer, table)``."""
    views = spark.sql("SHOW VIEWS").select(F.split("viewName", "_", 2).alias("parts"))
    return views.select(F.get("parts", F.lit(0)).alias("layer"), F.get("parts", F.lit(1)).alias("table")).filter(
        F.col("layer").isin("ods", "dwd", "ads", "serving")).orderBy("layer", "table")
