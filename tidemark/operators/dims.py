"""Dimensions of the event fact and its enrichment with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.expressions import newest
from tidemark.operators.skew import lookup_join


#: Attributes of an entity and which of their values count, in SQL.
REPO = {"repo_name": "repo_name <> ''", "org_login": "org_login <> ''", "language": "language IS NOT NULL"}
ACTOR = {"actor_login": "actor_login <> ''"}


def _spellings(rows: DataFrame, *by: str) -> DataFrame:
    """Events and the last time by ``by``, from events or from rows that stand for several."""
    folded = "events" in rows.columns
    return rows.groupBy(*by).agg(
        (F.sum("events") if folded else F.count("*")).alias("events"),
        F.max("last_ts" if folded else "event_ts").alias("last_ts"),
        *(x for x in (F.min("dt").alias("first_seen_dt"), F.max("dt").alias("last_seen_dt")) if "dt" not in by))


def repo_days(rows: DataFrame) -> DataFrame:
    """What a day adds to ``dim_repo``; replaced as a whole when the day is built anew."""
    return _spellings(rows, "dt", "repo_id", *REPO)


def actor_days(rows: DataFrame) -> DataFrame:
    return _spellings(rows, "dt", "actor_id", *ACTOR)


def _entity(rows: DataFrame, key: str, attributes: dict) -> DataFrame:
    """One row per key: size, first and last day, and the newest value of each attribute.

    The first grouping is by key *and* attribute values. Its buffers are plain
    numbers and dates, so it runs as a hash aggregate with map-side combine and
    folds a hot key down to its few spellings before anything is shuffled by
    the key alone; the string comparison then only sees those.
    """
    return _spellings(rows, key, *attributes).groupBy(key).agg(
        # A NULL key belongs to no entity: it keeps its counts and has no attributes.
        *[newest(name, "last_ts", F.expr(keep) & F.col(key).isNotNull()).alias(name) for name, keep in attributes.items()],
        F.sum("events").alias("event_cnt"),
        F.min("first_seen_dt").alias("first_seen_dt"),
        F.max("last_seen_dt").alias("last_seen_dt"),
    )


def dim_repo(rows: DataFrame) -> DataFrame:
    """Repositories: newest non-empty name and organisation, newest known language, each on its own.

    From the fact, its daily grain or ``repo_days``: the result is the same.
    """
    return _entity(rows, "repo_id", REPO)


def dim_actor(rows: DataFrame) -> DataFrame:
    return _entity(rows, "actor_id", ACTOR)


def dim_date(fact: DataFrame, day: str = "dt") -> DataFrame:
    """Every calendar day from the first to the last, gaps included; empty for an empty fact."""
    span = fact.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).filter(F.col("lo").isNotNull())
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date"))
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        F.weekofyear("date").alias("week_of_year"),
        F.dayofweek("date").alias("weekday"),
        F.dayofweek("date").isin(1, 7).alias("is_weekend"),
    )


def enrich_fact(fact: DataFrame, repos: DataFrame, actors: DataFrame, dates: DataFrame,
                rows_per_split: int = 2_000_000) -> DataFrame:
    """Fact rows with the current attributes of their repository, contributor and day.

    The calendar has one row per day and is broadcast. The entity dimensions
    grow with the data: they are shuffled, or broadcast by Spark where its own
    size check allows it, and hot keys are split.
    """
    repos = repos.select("repo_id", "event_cnt", F.col("repo_name").alias("repo_name_now"),
                         F.col("org_login").alias("org_login_now"), F.col("language").alias("repo_language"))
    actors = actors.select("actor_id", "event_cnt", F.col("actor_login").alias("actor_login_now"))
    wide = lookup_join(fact, repos, "repo_id", "event_cnt", "event_id", rows_per_split)
    wide = lookup_join(wide, actors, "actor_id", "event_cnt", "event_id", rows_per_split)
    calendar = F.broadcast(dates.select(F.col("date").alias("dt"), "week_of_year", "weekday", "is_weekend"))
    return wide.join(calendar, "dt", "left")
