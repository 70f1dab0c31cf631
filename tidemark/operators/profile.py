"""Acceptance report of the landed table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import fixed
from tidemark.functions.expressions import percent
from tidemark.operators import quality


def ods_profile(ods: DataFrame) -> DataFrame:
    """Size, distinct ids, names and days, and the first and last time (as text).

    Each distinct count is a query of its own: together they read every column
    once, as a single aggregate would, which however handles each row once per
    counted column and is several times slower on wide text keys.
    """
    counted = {"event_cnt": "event_id", "repo_cnt": "repo_name", "actor_cnt": "actor_login", "day_cnt": "dt"}
    plain = ods.agg(F.count("*").alias("row_cnt"), F.min("created_at").alias("first_at"),
                    F.max("created_at").alias("last_at"))
    distinct = [ods.select(c).distinct().agg(F.count(c).alias("n")).scalar().alias(n) for n, c in counted.items()]
    return plain.select("row_cnt", *distinct, "first_at", "last_at").withColumn(
        "unique_pct", percent(F.col("event_cnt"), F.col("row_cnt")))


def ods_null_audit(ods: DataFrame) -> DataFrame:
    return quality.null_audit(ods, "event_id", "event_type", "repo_name", "created_at")


def ods_duplicates(ods: DataFrame) -> DataFrame:
    return quality.duplicate_rate(ods, "event_id")


def ods_hour_coverage(ods: DataFrame) -> DataFrame:
    """Landed (day, hour) pairs against 24 per day, with one hour per day to spare."""
    covered = ods.agg(F.count_distinct("dt", "hour").alias("hour_cnt"), F.count_distinct("dt").alias("day_cnt"))
    return covered.withColumn("expected_cnt", F.col("day_cnt") * fixed.HOURS_PER_DAY).withColumn(
        "passed", F.col("hour_cnt") >= F.col("expected_cnt") - F.col("day_cnt"))


def ods_by_day(ods: DataFrame) -> DataFrame:
    return quality.hours_by_day(ods).orderBy("dt")


def ods_type_share(ods: DataFrame, top: int = 10) -> DataFrame:
    """The most frequent types with their percentage of all rows."""
    counts = ods.groupBy("event_type").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return (
        counts.select("event_type", "n", percent(F.col("n"), total, 1).alias("pct"))
        .orderBy(F.desc("n"), "event_type").limit(top)
    )


def ods_top_repos(ods: DataFrame, top: int = 10) -> DataFrame:
    counts = ods.groupBy("repo_name").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "repo_name").limit(top)


def mean_text_length(rows: DataFrame, column: str = "payload") -> DataFrame:
    return rows.agg(F.avg(F.length(column)).alias("mean_length"))
