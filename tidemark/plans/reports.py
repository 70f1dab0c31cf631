"""Dashboard and question reports over the rollups.

Each takes the rollup it reads, so it works on a stored table (cheap) and on a
rollup still to be computed (Catalyst then drops the measures it does not use).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions import fixed
from tidemark.functions.expressions import is_bot, percent, ratio

Day = dt.date | str | None


def between(table: DataFrame, first: Day = None, last: Day = None, column: str = "date") -> DataFrame:
    """Closed date range; an open end keeps everything on that side."""
    if first is not None:
        table = table.filter(F.col(column) >= F.lit(str(first)).cast("date"))
    if last is not None:
        table = table.filter(F.col(column) <= F.lit(str(last)).cast("date"))
    return table


def last_full_days(table: DataFrame, days: int = 7, column: str = "date", today: Day = None) -> DataFrame:
    """The last whole days before today, or before a given day."""
    end = F.current_date() if today is None else F.lit(str(today)).cast("date")
    return table.filter(F.col(column).between(F.date_sub(end, days), F.date_sub(end, 1)))


def on_dates(table: DataFrame, dates: list, column: str = "date") -> DataFrame:
    return table.filter(F.col(column).isin([F.lit(str(d)).cast("date") for d in dates]))


def _totals(table: DataFrame, by: str, **measures: str) -> DataFrame:
    return table.groupBy(by).agg(*[F.sum(c).alias(n) for n, c in measures.items()])


def _leaders(totals: DataFrame, tie: str, top: int) -> DataFrame:
    return totals.orderBy(F.desc("events"), tie).limit(top)


# --- dashboard -------------------------------------------------------------

def available_dates(daily_event_type: DataFrame) -> DataFrame:
    return daily_event_type.select("date").distinct().orderBy("date")


def kpi_range(summary: DataFrame, first: Day = None, last: Day = None) -> DataFrame:
    """Total events and days; repositories and contributors as daily means, since distinct counts do not add up."""
    return between(summary, first, last).agg(
        F.sum("events").alias("events"), F.count("*").alias("days"),
        F.avg("repos").alias("repos_daily"), F.avg("actors").alias("actors_daily"))


def range_distinct(distinct_days: DataFrame, summary: DataFrame, first: Day = None, last: Day = None) -> DataFrame:
    """Events, days, and the distinct repositories and contributors of the whole range, exactly.

    The bitmaps of the range's days are joined bucket by bucket; the events stay unread.
    """
    joined = between(distinct_days, first, last, "dt").groupBy("kind", "bucket").agg(F.bitmap_or_agg("bitmap").alias("ids"))
    counts = joined.agg(*(F.coalesce(F.sum(F.when(F.col("kind") == kind, F.bitmap_count("ids"))), F.lit(0)).alias(name)
                          for kind, name in (("repo", "repos"), ("actor", "actors"))))
    return between(summary, first, last).agg(F.coalesce(F.sum("events"), F.lit(0)).alias("events"), F.count("*").alias("days")).select(
        "*", *(counts.select(c).scalar().alias(c) for c in ("repos", "actors")))


def range_estimates(sketch_days: DataFrame, first: Day = None, last: Day = None) -> DataFrame:
    """Per kind of event: events, and estimates of the distinct repositories and contributors of the whole range.

    Joined from sketches of a few KB for each day; see ``fixed.SKETCH_SIZE`` for the error.
    """
    return between(sketch_days, first, last, "dt").groupBy("event_type").agg(
        F.sum("events").alias("events"), *(F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in ("repos", "actors")))


def event_mix(daily_event_type: DataFrame, first: Day = None, last: Day = None, top: int = 7) -> DataFrame:
    """Events per day and type; types outside the range's largest ``top`` become ``other``."""
    cells = between(daily_event_type, first, last).groupBy("date", "event_type").agg(F.sum("event_cnt").alias("n"))
    leading = (
        cells.groupBy("event_type").agg(F.sum("n").alias("total"))
        .orderBy(F.desc("total"), "event_type").limit(top)
        .select("event_type", F.lit(True).alias("leading"))
    )
    labelled = cells.join(F.broadcast(leading), "event_type", "left")  # at most `top` rows
    label = F.when(F.col("leading"), F.col("event_type")).otherwise("other")
    return labelled.groupBy("date", label.alias("kind")).agg(F.sum("n").alias("cnt"))


def repo_leaderboard(rank: DataFrame, first: Day = None, last: Day = None,
                     top: int = fixed.LEADERBOARD_ROWS) -> DataFrame:
    totals = _totals(between(rank, first, last), "repo_name", events="event_cnt", stars="star_cnt", prs="pr_cnt")
    return _leaders(totals, "repo_name", top)


def contributor_leaderboard(active: DataFrame, first: Day = None, last: Day = None,
                            hide_bots: bool = True, top: int = fixed.LEADERBOARD_ROWS) -> DataFrame:
    """``repos_daysum`` adds up daily distinct counts: a repository counts once per day."""
    rows = between(active, first, last)
    rows = rows.filter(~is_bot()) if hide_bots else rows
    return _leaders(_totals(rows, "actor_login", events="event_cnt", repos_daysum="repo_cnt"), "actor_login", top)


def org_leaderboard(rank: DataFrame, first: Day = None, last: Day = None,
                    top: int = fixed.LEADERBOARD_ROWS) -> DataFrame:
    totals = _totals(between(rank, first, last), "org_login",
                     events="event_cnt", repos_daysum="repo_cnt", actors_daysum="actor_cnt")
    return _leaders(totals, "org_login", top)


def hour_heatmap(hourly: DataFrame, first: Day = None, last: Day = None) -> DataFrame:
    return between(hourly, first, last).groupBy("date", "hour").agg(F.sum("event_cnt").alias("cnt"))


def hour_heatmap_wide(heatmap: DataFrame) -> DataFrame:
    """One row per day, one column per hour of the day, 0 where nothing happened."""
    hours = list(range(fixed.HOURS_PER_DAY))
    wide = heatmap.groupBy("date").pivot("hour", hours).agg(F.sum("cnt"))
    return wide.na.fill(0).withColumnsRenamed({str(h): f"h{h:02d}" for h in hours})


def peak_trough(heatmap: DataFrame) -> DataFrame:
    """Busiest and quietest hour (the earliest of equals) and their ratio."""
    ends = heatmap.agg(
        F.min(F.struct((-F.col("cnt")).alias("order"), "date", "hour", "cnt")).alias("peak"),
        F.min(F.struct(F.col("cnt").alias("order"), "date", "hour", "cnt")).alias("low"))
    return ends.select(
        *[F.col(f"{e}.{c}").alias(f"{e}_{c}") for e in ("peak", "low") for c in ("date", "hour", "cnt")],
        (F.col("peak.cnt") / F.greatest("low.cnt", F.lit(1))).alias("peak_ratio"))


def funnel_series(funnel: DataFrame, first: Day = None, last: Day = None) -> DataFrame:
    daily = between(funnel, first, last).groupBy("date").agg(
        *[F.sum(f"{a}_cnt").alias(a) for a in ("opened", "merged", "closed")])
    return daily.withColumn("merge_rate", ratio(F.col("merged"), F.col("merged") + F.col("closed"))).orderBy("date")


def funnel_long(series: DataFrame) -> DataFrame:
    return series.unpivot("date", ["opened", "merged", "closed"], "action", "n")


# --- questions -------------------------------------------------------------

def bot_share(active: DataFrame) -> DataFrame:
    """Events of automated and human accounts and their percentage of all; a login that is NULL counts as human."""
    kinds = active.groupBy(F.when(is_bot(), "bot").otherwise("human").alias("kind")).agg(
        F.sum("event_cnt").alias("events"))
    whole = F.sum("events").over(Window.partitionBy())  # two rows
    return kinds.withColumn("pct", percent(F.col("events"), whole)).orderBy(F.desc("events"), "kind")


def daily_merge_rate(funnel: DataFrame) -> DataFrame:
    done = F.col("merged_cnt") + F.col("closed_cnt")
    return funnel.select("date", "opened_cnt", "merged_cnt", "closed_cnt",
                         ratio(F.col("merged_cnt"), done).alias("merge_rate")).orderBy("date")


def top10_repos(rank: DataFrame) -> DataFrame:
    return repo_leaderboard(rank, top=10)


def events_by_hour(hourly: DataFrame) -> DataFrame:
    return _totals(hourly, "hour", events="event_cnt").orderBy(F.desc("events"), "hour")


def top10_orgs(rank: DataFrame) -> DataFrame:
    return org_leaderboard(rank, top=10)


def event_type_totals(daily_event_type: DataFrame) -> DataFrame:
    return _totals(daily_event_type, "event_type", events="event_cnt").orderBy(F.desc("events"), "event_type")


def scale_overview(fact: DataFrame) -> DataFrame:
    """Rows, repositories, contributors and days, in one pass over the fact."""
    return fact.agg(
        F.count("*").alias("events"), F.count_distinct("repo_id").alias("repos"),
        F.count_distinct("actor_id").alias("actors"), F.count_distinct("dt").alias("days"))


def top10_contributors(active: DataFrame) -> DataFrame:
    return contributor_leaderboard(active, top=10)


#: Canned questions by topic name: the table each reads, and the report.
QUESTIONS = {
    "bot_share": ("daily_actor_active", bot_share),
    "daily_merge_rate": ("daily_pr_funnel", daily_merge_rate),
    "top10_repos": ("daily_repo_rank", top10_repos),
    "events_by_hour": ("hourly_activity", events_by_hour),
    "top10_orgs": ("daily_org_rank", top10_orgs),
    "event_type_totals": ("daily_event_type", event_type_totals),
    "scale_overview": ("event_fact", scale_overview),
    "top10_contributors": ("daily_actor_active", top10_contributors),
}
