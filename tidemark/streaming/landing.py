"""Landing and fact building as streams over the landing zone.

The same transformations as the batch jobs; the checkpoint remembers which
files are done, so a run continues where the last one stopped. With the
default trigger a run handles what has arrived and ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import schemas
from tidemark.plans.warehouse import build_fact_days, land

_FILE = "path string, modificationTime timestamp, length long, content binary, dt date"


def land_stream(spark: SparkSession, raw_root: str, ods_path: str, checkpoint: str,
                hour_folders: bool = False, files_per_batch: int = 10_000) -> StreamingQuery:
    """Land the days that new raw files belong to.

    A batch says which days to look at, from the names of its files alone; landing itself finds the
    files that are due and opens each once, so neither the size of a batch nor a repeated one
    changes the rows.
    """
    files = (
        spark.readStream.format("binaryFile").schema(_FILE + (", hour int" if hour_folders else ""))
        .option("pathGlobFilter", "*.gz").option("maxFilesPerTrigger", files_per_batch).load(raw_root)
        .select("dt")  # before the sink, or each batch would fetch the files to learn their days
    )

    def write(batch: DataFrame, _: int) -> None:
        days = [r.dt for r in batch.select("dt").distinct().collect()]  # one per calendar day
        if days:
            land(batch.sparkSession, raw_root, ods_path, days=days)

    return (files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def fact_stream(spark: SparkSession, ods_path: str, fact_path: str, checkpoint: str) -> StreamingQuery:
    """Build the fact anew for the days of newly landed files, so that an hour landed again is not counted twice.

    The stream reads the folders' names and no row.
    """
    partitions = [T.StructField("dt", T.DateType()), T.StructField("hour", T.IntegerType()), T.StructField("file", T.StringType())]
    ods = spark.readStream.schema(T.StructType(schemas.ODS.fields + partitions)).parquet(ods_path).select("dt")

    def build(batch: DataFrame, _: int) -> None:
        days = [r.dt for r in batch.select("dt").distinct().collect()]  # one per calendar day
        build_fact_days(batch.sparkSession, ods_path, fact_path, days=days)

    return (ods.writeStream.foreachBatch(build).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
