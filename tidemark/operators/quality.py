"""Quality metrics, the five rules built on them, and their report.

Every metric is one aggregation with a one-row result. Windows and lists here
hold one entry per calendar day, never per event.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions import fixed
from tidemark.functions.expressions import count_where, is_blank

BLOCK, WARN = "block", "warn"


def on_day(df: DataFrame, day: dt.date | str | None, column: str = "dt") -> DataFrame:
    """Rows of one day (a pruned partition read), or all of them."""
    return df if day is None else df.filter(F.col(column) == F.lit(str(day)).cast("date"))


def null_audit(df: DataFrame, *columns: str) -> DataFrame:
    """Number of NULL or empty values per column, with the number of rows."""
    return df.agg(F.count("*").alias("row_cnt"), *[count_where(is_blank(c)).alias(f"{c}_blank") for c in columns])


def duplicate_rate(df: DataFrame, *key: str) -> DataFrame:
    """Rows beyond the first per key. The distinct count is spread over tasks by the key."""
    rows, unique = F.count("*"), F.count_distinct(*key)
    return df.agg(rows.alias("row_cnt"), unique.alias("unique_cnt")).select(
        "*",
        (F.col("row_cnt") - F.col("unique_cnt")).alias("duplicate_cnt"),
        ((F.col("row_cnt") - F.col("unique_cnt")) / F.greatest("row_cnt", F.lit(1))).alias("duplicate_rate"),
    ).withColumn("passed", F.col("duplicate_rate") < fixed.MAX_DUPLICATE_RATE)


def hours_by_day(df: DataFrame, day: str = "dt", hour: str = "hour") -> DataFrame:
    return df.groupBy(F.col(day).alias("dt")).agg(
        F.count_distinct(hour).alias("hour_cnt"), F.count("*").alias("row_cnt"))


def hour_completeness(df: DataFrame, day: str = "dt", hour: str = "hour") -> DataFrame:
    """The poorest day's number of hours and the days short of 24, of the days present."""
    short = F.col("hour_cnt") < fixed.HOURS_PER_DAY
    listed = F.transform(
        F.array_sort(F.collect_list(F.when(short, F.struct("dt", "hour_cnt")))),
        lambda x: F.concat(x["dt"].cast("string"), F.lit(" ("), x["hour_cnt"].cast("string"), F.lit("h)")))
    return hours_by_day(df, day, hour).agg(
        F.count("*").alias("days"),
        F.coalesce(F.min("hour_cnt"), F.lit(0)).alias("worst_hours"),
        count_where(short).alias("short_days"),
        F.concat_ws(", ", listed).alias("short_list"),
    ).withColumn("passed", F.col("worst_hours") >= fixed.MIN_HOURS_PER_DAY)


def daily_changes(df: DataFrame, day: str = "dt") -> DataFrame:
    """Rows per day with the relative change from the day before it among the days present."""
    counts = df.groupBy(F.col(day).alias("dt")).agg(F.count("*").alias("n"))
    in_order = Window.orderBy("dt")  # one row per day
    return (
        counts.withColumn("prev_dt", F.lag("dt").over(in_order))
        .withColumn("prev_n", F.lag("n").over(in_order))
        .withColumn("change", F.when(F.col("prev_n") > 0, F.abs(F.col("n") - F.col("prev_n")) / F.col("prev_n")))
    )


def _upper_median(column: str) -> Column:
    """Middle value, the larger of the two for an even number; ``median`` would take their mean."""
    values = F.array_sort(F.collect_list(column))
    return F.get(values, F.floor(F.size(values) / 2).cast("int"))


def volatility(df: DataFrame, day: str = "dt", limit: float = fixed.MAX_DAILY_CHANGE) -> DataFrame:
    """The steepest change between neighbouring days present, and the upper median of all changes."""
    rise = F.when(F.col("change") > 0, F.struct((-F.col("change")).alias("order"), "dt", "prev_dt"))
    return daily_changes(df, day).agg(
        F.count("*").alias("days"),
        F.coalesce(F.max("change"), F.lit(0.0)).alias("worst_change"),
        F.min(rise).alias("_worst"),
        F.coalesce(_upper_median("change"), F.lit(0.0)).alias("median_change"),
    ).select(
        "days", "worst_change",
        F.col("_worst.prev_dt").alias("worst_from"), F.col("_worst.dt").alias("worst_to"), "median_change",
        ((F.col("worst_change") < limit) | (F.col("days") < 2)).alias("passed"),
    )


def volatility_calibration(df: DataFrame, day: str = "dt") -> DataFrame:
    """Spread of the daily changes and the limit mean + 2 standard deviations it suggests."""
    return daily_changes(df, day).agg(
        F.count("change").alias("changes"),
        F.min("change").alias("min_change"),
        _upper_median("change").alias("median_change"),
        F.round(F.avg("change"), 9).alias("mean_change"),
        F.round(F.stddev("change"), 9).alias("stddev_change"),
        F.max("change").alias("max_change"),
        F.round(F.avg("change") + 2 * F.stddev("change"), 9).alias("suggested_limit"),
    )


def volume_spread(df: DataFrame, day: str = "dt") -> DataFrame:
    counts = df.groupBy(F.col(day).alias("dt")).agg(F.count("*").alias("n"))
    return counts.agg(
        F.count("*").alias("days"), F.min("n").alias("min_rows"), F.max("n").alias("max_rows"),
        (F.max("n") / F.min("n")).alias("spread"))


def unknown_values(df: DataFrame, column: str, known: list[str]) -> DataFrame:
    """Rows outside the list; NULL is not counted."""
    return df.agg(count_where(~F.col(column).isin(known)).alias("unknown_cnt")).withColumn(
        "passed", F.col("unknown_cnt") == 0)


def column_coverage(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count("*").alias("row_cnt"), F.count(column).alias("filled_cnt")).withColumn(
        "coverage", F.col("filled_cnt") / F.greatest("row_cnt", F.lit(1)))


def filter_drop(df: DataFrame, keep: Column) -> DataFrame:
    """Rows before and after a filter, in one pass."""
    return df.agg(F.count("*").alias("row_cnt"), count_where(keep).alias("kept_cnt")).select(
        "*", (F.col("row_cnt") - F.col("kept_cnt")).alias("dropped_cnt")
    ).withColumn("dropped_pct", F.col("dropped_cnt") * 100 / F.greatest("row_cnt", F.lit(1)))


def _rule(metric: DataFrame, rule: str, name: str, target: str, value: str, expect: str,
          action: str, *detail) -> DataFrame:
    return metric.select(
        F.lit(rule).alias("id"), F.lit(name).alias("name"), F.lit(target).alias("target"),
        F.col(value).cast("double").alias("value"), F.lit(expect).alias("expect"), "passed",
        F.lit(action).alias("action"), F.concat(*detail).alias("detail"))


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def quality_rules(ods: DataFrame, fact: DataFrame, day: dt.date | str | None = None) -> DataFrame:
    """The five rules, one row each: value, expectation, verdict and what a failure means."""
    ods, fact = on_day(ods, day), on_day(fact, day)
    keys = ["event_id", "event_type", "created_at"]
    blanks = null_audit(ods, *keys).withColumn("bad", sum(F.col(f"{k}_blank") for k in keys))
    return reduce(DataFrame.unionByName, [
        _rule(blanks.withColumn("passed", F.col("bad") == 0), "R1", "not null", "ods.events", "bad", "= 0", BLOCK,
              _text("row_cnt"), F.lit(" rows | blank"),
              *[x for k in keys for x in (F.lit(f" {k} "), _text(f"{k}_blank"))]),
        _rule(duplicate_rate(fact, "event_id"), "R2", "unique", "dwd.event_fact", "duplicate_rate", "< 0.1%", WARN,
              _text("duplicate_cnt"), F.lit(" duplicates | "), _text("row_cnt"), F.lit(" rows, "),
              _text("unique_cnt"), F.lit(" distinct")),
        _rule(hour_completeness(ods), "R3", "complete", "ods.events", "worst_hours", ">= 23", WARN,
              _text("short_days"), F.lit("/"), _text("days"), F.lit(" days short of 24 hours: "), F.col("short_list")),
        _rule(volatility(fact), "R4", "volatility", "dwd.event_fact", "worst_change", "< 100%", WARN,
              F.lit("steepest "), F.coalesce(_text("worst_from"), F.lit("none")), F.lit(" to "),
              F.coalesce(_text("worst_to"), F.lit("none")), F.lit(" | "), _text("days"), F.lit(" days")),
        _rule(unknown_values(fact, "event_type", fixed.EVENT_TYPES), "R5", "enum", "dwd.event_fact", "unknown_cnt",
              "all known", WARN, F.lit(f"{len(fixed.EVENT_TYPES)} known types")),
    ])


def quality_summary(rules: DataFrame, scope: str = "all") -> DataFrame:
    """Totals over the rules; ``gate_open`` is false iff a blocking rule failed."""
    failed = ~F.col("passed")
    return rules.agg(
        F.lit(scope).alias("scope"),
        F.count("*").alias("total"),
        count_where(F.col("passed")).alias("passed"),
        count_where(failed).alias("failed"),
        count_where(failed & (F.col("action") == BLOCK)).alias("blocking_failed"),
    ).withColumn("gate_open", F.col("blocking_failed") == 0)


def quality_document(rules: DataFrame, scope: str = "all") -> DataFrame:
    """The report as one nested row: time, scope, summary and the rules in order."""
    summary = F.struct(
        F.count("*").alias("total"),
        count_where(F.col("passed")).alias("passed"),
        count_where(~F.col("passed")).alias("failed"),
        count_where(~F.col("passed") & (F.col("action") == BLOCK)).alias("blocking_failed"))
    listed = F.array_sort(F.collect_list(F.struct(*rules.columns)))  # five rules
    return rules.agg(summary.alias("summary"), listed.alias("rules")).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("generated_at"),
        F.lit(scope).alias("scope"), "summary", "rules")


def expected_hours(spark: SparkSession, first: dt.date | str, last: dt.date | str) -> DataFrame:
    """Every ``(dt, hour)`` from the first day's 0 h to the last day's 23 h."""
    return hour_grid(spark.range(1).select(
        F.lit(str(first)).cast("date").alias("lo"), F.lit(str(last)).cast("date").alias("hi")))


def hour_grid(span: DataFrame) -> DataFrame:
    """Every hour from day ``lo`` to day ``hi`` of a one-row frame."""
    start = F.col("lo").cast("timestamp_ntz")
    end = F.col("hi").cast("timestamp_ntz") + F.expr("interval 23 hours")
    return span.filter(F.col("lo").isNotNull()).select(
        F.explode(F.sequence(start, end, F.expr("interval 1 hour"))).alias("at")
    ).select(F.to_date("at").alias("dt"), F.hour("at").alias("hour"))


def missing_hours(landed: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Expected hours without a landed row; by default every hour of the span of landed days.

    For a stored table pass ``tables.stored_partitions``: its listing answers without a scan.
    """
    if expected is None:
        expected = hour_grid(landed.agg(F.min("dt").alias("lo"), F.max("dt").alias("hi")))
    return expected.join(landed.select("dt", "hour").distinct(), ["dt", "hour"], "left_anti")
