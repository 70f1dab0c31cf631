import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import physical, rows
from tidemark.operators import dims
from tidemark.operators.fact import fact_from_ods
from tidemark.operators.skew import lookup_join
from tidemark.sources.adapter import ods_from_events

FACT = "event_id string, actor_id long, actor_login string, repo_id long, repo_name string, org_login string, " \
       "language string, event_ts timestamp, dt date"


def at(day, second=0):
    return dt.datetime(2024, 1, day, 0, 0, second)


def fact(spark, *events):
    """Events as (repo_id, name, org, language, time)."""
    return spark.createDataFrame(
        [(str(i), r, f"u{r}", r, n, o, lang, t, (t or at(14)).date()) for i, (r, n, o, lang, t) in enumerate(events)], FACT)


def test_each_attribute_is_the_newest_on_its_own(spark):
    df = fact(spark, (1, "old", "org", None, at(14)), (1, "", "", "Go", at(15)), (1, "new", "", None, at(16)),
              (1, "", "", None, at(17)))
    assert tuple(dims.dim_repo(df).first()) == (
        1, "new", "org", "Go", 4, dt.date(2024, 1, 14), dt.date(2024, 1, 17))


def test_equal_times_are_repeatable(spark):
    one = fact(spark, (1, "a", "", None, at(14)), (1, "b", "", None, at(14)))
    two = fact(spark, (1, "b", "", None, at(14)), (1, "a", "", None, at(14)))
    assert dims.dim_repo(one).first().repo_name == dims.dim_repo(two).first().repo_name == "b"


def test_event_without_time_counts_but_names_nothing(spark):
    got = dims.dim_repo(fact(spark, (1, "a", "", None, at(14)), (1, "z", "", None, None))).first()
    assert (got.repo_name, got.event_cnt) == ("a", 2)


def test_null_key_keeps_counts_only(spark):
    got = dims.dim_repo(fact(spark, (None, "x", "o", "Go", at(14)), (None, "y", "", None, at(15)))).first()
    assert (got.repo_id, got.repo_name, got.org_login, got.language, got.event_cnt) == (None, None, None, None, 2)


def _join_form(fact_df, key, *attributes):
    """Counts, then one grouped lookup per attribute joined to them."""
    out = fact_df.groupBy(key).agg(F.count("*").alias("event_cnt"), F.min("dt").alias("first_seen_dt"),
                                   F.max("dt").alias("last_seen_dt"))
    for name in attributes:
        newest = fact_df.filter(F.col(name) != "").groupBy(key).agg(
            F.max_by(name, F.struct("event_ts", name)).alias(name))
        out = out.join(newest, key, "left")
    return out


def test_equals_join_form(spark, sf):
    df = fact_from_ods(ods_from_events(spark, sf))
    repo, actor = dims.dim_repo(df), dims.dim_actor(df)
    assert rows(repo) == rows(_join_form(df, "repo_id", "repo_name", "org_login", "language").select(repo.columns))
    assert rows(actor) == rows(_join_form(df, "actor_id", "actor_login").select(actor.columns))


def test_first_grouping_is_a_hash_aggregate(spark, sf):
    plan = physical(dims.dim_repo(fact_from_ods(ods_from_events(spark, sf))))
    scan_side = plan[plan.rindex("Exchange"):]
    assert "HashAggregate" in scan_side and "SortAggregate" not in scan_side


def test_calendar_fills_gaps(spark):
    got = dims.dim_date(fact(spark, (1, "a", "", None, at(14)), (1, "a", "", None, at(16))))
    assert [tuple(r) for r in got.orderBy("date").collect()] == [
        (dt.date(2024, 1, 14), 2024, 1, 14, 2, 1, True),
        (dt.date(2024, 1, 15), 2024, 1, 15, 3, 2, False),
        (dt.date(2024, 1, 16), 2024, 1, 16, 3, 3, False)]
    assert dims.dim_date(fact(spark).filter("false")).count() == 0


@pytest.mark.parametrize("per_split", [1, 7, 10_000_000])
def test_enrichment_is_a_left_join_whatever_the_split(spark, sf, per_split):
    df = fact_from_ods(ods_from_events(spark, sf)).withColumn(
        "repo_id", F.when(F.col("push_size") != 0, F.col("repo_id")))
    repos, actors, dates = dims.dim_repo(df), dims.dim_actor(df), dims.dim_date(df)
    got = dims.enrich_fact(df, repos, actors, dates, rows_per_split=per_split)
    want = (
        df.join(repos.select("repo_id", F.col("repo_name").alias("repo_name_now"),
                             F.col("org_login").alias("org_login_now"), F.col("language").alias("repo_language")),
                "repo_id", "left")
        .join(actors.select("actor_id", F.col("actor_login").alias("actor_login_now")), "actor_id", "left")
        .join(dates.select(F.col("date").alias("dt"), "week_of_year", "weekday", "is_weekend"), "dt", "left"))
    assert rows(got.select(*want.columns)) == rows(want)


def test_hot_and_null_keys_are_spread(spark):
    facts = spark.range(8000).select(
        F.when(F.col("id") < 3000, 1).when(F.col("id") < 6000, None).otherwise(F.col("id")).cast("long").alias("k"), "id")
    lookup = facts.groupBy("k").agg(F.count("*").alias("n")).withColumn("name", F.concat(F.lit("n"), "k"))
    got = lookup_join(facts, lookup, "k", "n", "id", rows_per_split=100)
    assert got.count() == 8000
    assert got.filter("k = 1 and name = 'n1'").count() == 3000
    assert got.filter("k is null and name is null").count() == 3000


def test_no_task_holds_a_hot_key(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        facts = spark.range(90_000).select(
            F.when(F.col("id") < 30_000, 1).when(F.col("id") < 60_000, None).otherwise(F.col("id")).cast("long")
            .alias("k"), "id")
        lookup = facts.groupBy("k").agg(F.count("*").alias("n"))
        got = lookup_join(facts, lookup, "k", "n", "id", rows_per_split=500)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 90_000 and max(sizes) < 20_000  # 8 partitions, 11,250 on average
