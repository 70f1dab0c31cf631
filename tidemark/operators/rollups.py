"""Daily and hourly rollups of the event fact, or of its daily grain.

The grain folds events that agree in all that the rollups group and count by, and says how
many there are. It is read in place of the fact: every rollup takes either. Exact distinct counts are planned by Spark on (keys, counted value) first, so a
day or a key that holds a large share of the rows is spread by the counted
value and only partial counts meet at the key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions import fixed
from tidemark.functions.expressions import count_where, ratio, type_counts


#: What the grain keeps apart: all that rollups and dimensions group or count by.
GRAIN = ["dt", "hour", "event_type", "pr_action", "repo_id", "repo_name", "org_login", "language", "actor_id", "actor_login"]


def daily_grain(fact: DataFrame) -> DataFrame:
    """``GRAIN`` with the number of events and the time of the last one, from a single scan of the fact."""
    return fact.withColumn("hour", F.hour("event_ts")).groupBy(*GRAIN).agg(
        F.count("*").alias("events"), F.max("event_ts").alias("last_ts"))


def _weight(rows: DataFrame) -> Column | None:
    """The events that a row stands for; None where each is one."""
    return F.col("events") if "events" in rows.columns else None


def _events(rows: DataFrame) -> Column:
    return F.count("*") if _weight(rows) is None else F.sum("events")


def daily_event_type(fact: DataFrame) -> DataFrame:
    return fact.groupBy(F.col("dt").alias("date"), "event_type").agg(
        _events(fact).alias("event_cnt"), F.count_distinct("actor_id").alias("actor_cnt"))


def _daily_rank(fact: DataFrame, key: str, label: str, distinct: dict, counts: list, exact: bool) -> DataFrame:
    """Per day, key and label; the per-kind counts are those of the whole key unless ``exact``.

    A key under two labels on one day thus has two rows, both with the key's
    full per-kind counts, and summing them over labels counts them twice. The
    window runs over grouped rows, one per label of a key and day. Rows without
    a key have no per-kind counts; they are windowed by label so that they do
    not meet in one task.
    """
    ranked = fact.groupBy(F.col("dt").alias("date"), key, label).agg(
        _events(fact).alias("event_cnt"),
        *[F.count_distinct(c).alias(n) for n, c in distinct.items()],
        *type_counts(counts, weight=_weight(fact)),
    )
    return ranked if exact else _whole_key(ranked, key, label, counts)


def _whole_key(ranked: DataFrame, key: str, label: str, counts: list) -> DataFrame:
    window = Window.partitionBy("date", key, F.when(F.col(key).isNull(), F.col(label)))
    return ranked.withColumns({
        n: F.when(F.col(key).isNotNull(), F.sum(n).over(window)) for n in counts
    })


def top_rank_per_day(fact: DataFrame, name: str, rows: int = fixed.EXTRACT_ROWS_PER_DAY) -> DataFrame:
    """``top_per_day`` of a rank table straight from the fact.

    Labels are ranked by their own events first and cut to the top rows in every
    task. The counts of whole keys, which play no part in the order, are then
    taken for the keys that are left: at most ``rows`` for each day.
    """
    build, (key, *rest) = ADS_TABLES[name], RANK_TIES[name]
    if not rest:
        return top_per_day(build(fact), key, rows=rows)
    counts = list(fixed.COUNT_COLUMNS)
    top = top_per_day(build(fact, exact=True), key, *rest, rows=rows)
    keys = top.filter(F.col(key).isNotNull()).select("date", key).distinct()
    whole = fact.filter(F.col(key).isNotNull()).select(F.col("dt").alias("date"), *[c for c in fact.columns if c != "date"]).join(
        keys, ["date", key], "left_semi").groupBy("date", key).agg(*type_counts(counts, weight=_weight(fact)))
    return top.drop(*counts).join(whole, ["date", key], "left").select(top.columns)


def daily_repo_rank(fact: DataFrame, exact: bool = False) -> DataFrame:
    return _daily_rank(fact, "repo_id", "repo_name", {"actor_cnt": "actor_id"},
                       list(fixed.COUNT_COLUMNS), exact)


def daily_actor_active(fact: DataFrame, exact: bool = False) -> DataFrame:
    return _daily_rank(fact, "actor_id", "actor_login", {"repo_cnt": "repo_id"},
                       ["push_cnt", "pr_cnt", "issue_cnt"], exact)


def daily_org_rank(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("org_login") != "").groupBy(F.col("dt").alias("date"), "org_login").agg(
        _events(fact).alias("event_cnt"),
        F.count_distinct("repo_id").alias("repo_cnt"),
        F.count_distinct("actor_id").alias("actor_cnt"),
    )


def hourly_activity(fact: DataFrame) -> DataFrame:
    hour = F.col("hour") if "hour" in fact.columns else F.hour("event_ts")
    return fact.groupBy(F.col("dt").alias("date"), hour.alias("hour")).agg(
        _events(fact).alias("event_cnt"),
        F.count_distinct("actor_id").alias("actor_cnt"),
        F.count_distinct("repo_id").alias("repo_cnt"),
    )


def action_funnel(rows: DataFrame, day: str, action: str, distinct: dict) -> DataFrame:
    """Rows per day by funnel action, with the rate of merged among finished ones."""
    counted = rows.groupBy(F.col(day).alias("date")).agg(
        *[count_where(F.col(action) == a, _weight(rows)).alias(f"{a}_cnt") for a in fixed.FUNNEL_ACTIONS],
        _events(rows).alias("total_cnt"),
        *[F.count_distinct(c).alias(n) for n, c in distinct.items()],
    )
    done = F.col("merged_cnt") + F.col("closed_cnt")
    return counted.withColumn("merge_rate", ratio(F.col("merged_cnt"), done))


def daily_pr_funnel(fact: DataFrame) -> DataFrame:
    return action_funnel(fact.filter(F.col("event_type") == "PullRequestEvent"), "dt", "pr_action",
                         {"repo_cnt": "repo_id", "actor_cnt": "actor_id"})


def daily_summary(fact: DataFrame) -> DataFrame:
    return fact.groupBy(F.col("dt").alias("date")).agg(
        _events(fact).alias("events"),
        F.count_distinct("repo_id").alias("repos"),
        F.count_distinct("actor_id").alias("actors"),
    )


def distinct_days(rows: DataFrame) -> DataFrame:
    """Per day the distinct repositories and contributors as bitmaps: exact, and they can be joined over any range.

    Ids are cut into buckets of 32,768 numbers, each with a bitmap of 4 KB, so a day has as many rows as
    there are buckets with an id in them. Ids that are NULL are not counted.
    """
    kinds = F.explode(F.array(*(F.struct(F.lit(kind).alias("kind"), F.col(column).alias("id"))
                                for kind, column in (("repo", "repo_id"), ("actor", "actor_id")))))
    ids = rows.select("dt", kinds.alias("of")).select("dt", "of.kind", "of.id").filter("id IS NOT NULL")
    return ids.groupBy("dt", "kind", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bitmap"))


def sketch_days(rows: DataFrame, size: int = fixed.SKETCH_SIZE) -> DataFrame:
    """Per day and kind of event sketches of the distinct repositories and contributors: a few KB, whatever the day."""
    return rows.groupBy("dt", "event_type").agg(
        _events(rows).alias("events"), F.hll_sketch_agg("repo_id", F.lit(size)).alias("repos"),
        F.hll_sketch_agg("actor_id", F.lit(size)).alias("actors"))


def dataset_meta(summary: DataFrame, kind: str = "full") -> DataFrame:
    return summary.agg(
        F.count("*").alias("days"), F.min("date").alias("date_from"), F.max("date").alias("date_to"),
    ).select(F.current_timestamp().alias("built_at"), "*", F.lit(kind).alias("kind"))


def top_per_day(rank: DataFrame, *tie: str, rows: int = fixed.EXTRACT_ROWS_PER_DAY,
                day: str = "date", measure: str = "event_cnt") -> DataFrame:
    """The largest rows of each day.

    Planned with a partial limit, so that a long day is cut before its shuffle, unless
    ``rank`` ends in a window of its own: then ``top_rank_per_day`` is the way.
    """
    place = F.row_number().over(Window.partitionBy(day).orderBy(F.desc(measure), *tie))
    return rank.withColumn("_place", place).filter(F.col("_place") <= rows).drop("_place")


#: Application tables by name, in build order.
ADS_TABLES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "daily_event_type": daily_event_type,
    "daily_repo_rank": daily_repo_rank,
    "daily_actor_active": daily_actor_active,
    "daily_org_rank": daily_org_rank,
    "hourly_activity": hourly_activity,
    "daily_pr_funnel": daily_pr_funnel,
}

#: Tables kept by day that further tables are made from.
DAY_STATES: dict[str, Callable[[DataFrame], DataFrame]] = {"distinct_days": distinct_days, "sketch_days": sketch_days}

#: Sort keys that make the daily extract of a rank table repeatable.
RANK_TIES = {
    "daily_repo_rank": ("repo_id", "repo_name"),
    "daily_actor_active": ("actor_id", "actor_login"),
    "daily_org_rank": ("org_login",),
}
