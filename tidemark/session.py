"""Session settings the jobs rely on."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor, wait
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")

#: Settings that change results (time zone) or keep partitioned writes from
#: sorting wide rows; sizing (memory, cores, shuffle partitions) is the caller's.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.maxConcurrentOutputFileWriters": "32",
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_spark(app_name: str = "tidemark", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> None:
    """Hours and dates are UTC by definition of the source files."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


#: Jobs that are submitted at a time: small ones share the cluster, and none waits for another's last task.
AT_ONCE = 4


def side_by_side(spark: SparkSession, steps: Iterable[Callable[[], T]], at_once: int = AT_ONCE) -> list[T]:
    """The results of steps that need nothing of each other, in order.

    All have ended when this returns or raises the error of the first that failed.
    """
    with ThreadPoolExecutor(at_once) as pool:
        runs = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        wait(runs)
    return [run.result() for run in runs]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path in the cluster's shared checkpoint folder, deleted when the driver ends.

    An error where no folder is set: a local one would not be seen by other machines.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        folder = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = folder.get() if folder.isDefined() else None
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    atexit.register(delete, spark, path)
    return path


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder, if the application is still there."""
    context = spark.sparkContext
    if context._jsc is not None and not context._jsc.sc().isStopped():
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
