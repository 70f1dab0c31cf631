import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import physical, plan_of, rows
from tidemark.operators import rollups
from tidemark.plans import reports
from tidemark.sources.adapter import fact_from_events

FACT = "event_id string, event_type string, actor_id long, actor_login string, repo_id long, repo_name string, " \
       "org_login string, event_ts timestamp, dt date, pr_action string"
D14, D15 = dt.date(2024, 1, 14), dt.date(2024, 1, 15)


def fact(spark, *events):
    """Events as dicts over a default row."""
    base = dict(event_type="PushEvent", actor_id=1, actor_login="a", repo_id=7, repo_name="o/r", org_login="",
                event_ts=dt.datetime(2024, 1, 14, 5), dt=D14, pr_action=None)
    names = [c.split()[0] for c in FACT.split(", ")]
    made = [base | {"event_id": str(i)} | e for i, e in enumerate(events)]
    return spark.createDataFrame([tuple(e[n] for n in names) for e in made], FACT)


def test_renamed_repo_has_full_counts_under_both_names(spark):
    df = fact(spark, {}, {}, {"repo_name": "o/new"}, {"repo_name": "o/new", "event_type": "WatchEvent"})
    got = {r.repo_name: r for r in rollups.daily_repo_rank(df).collect()}
    assert {(r.push_cnt, r.star_cnt) for r in got.values()} == {(3, 1)}
    assert {n: r.event_cnt for n, r in got.items()} == {"o/r": 2, "o/new": 2}
    exact = {r.repo_name: (r.push_cnt, r.star_cnt) for r in rollups.daily_repo_rank(df, exact=True).collect()}
    assert exact == {"o/r": (2, 0), "o/new": (1, 1)}


def test_null_key_has_no_counts(spark):
    df = fact(spark, {"repo_id": None, "repo_name": "x"}, {"repo_id": None, "repo_name": "y"}, {"repo_id": None, "repo_name": "y"})
    got = {r.repo_name: (r.event_cnt, r.push_cnt, r.issue_cnt) for r in rollups.daily_repo_rank(df).collect()}
    assert got == {"x": (1, None, None), "y": (2, None, None)}


def test_actor_rank_of_renames_and_missing_names(spark):
    """A login that changes within a day, a NULL login and a NULL id, all by hand."""
    df = fact(spark, {"repo_id": 7}, {"repo_id": 8, "event_type": "PullRequestEvent"}, {"actor_login": "b", "repo_id": 7},
              {"actor_login": None, "event_type": "IssuesEvent"}, {"actor_id": None, "actor_login": None}, {"actor_id": None, "actor_login": None},
              {"dt": D15, "event_type": "WatchEvent"})
    got = {(r.date, r.actor_id, r.actor_login): (r.event_cnt, r.repo_cnt, r.push_cnt, r.pr_cnt, r.issue_cnt)
           for r in rollups.daily_actor_active(df).collect()}
    assert got == {(D14, 1, "a"): (2, 2, 2, 1, 1), (D14, 1, "b"): (1, 1, 2, 1, 1), (D14, 1, None): (1, 1, 2, 1, 1),
                   (D14, None, None): (2, 1, None, None, None), (D15, 1, "a"): (1, 1, 0, 0, 0)}


@pytest.mark.parametrize("name", [*rollups.ADS_TABLES, "daily_summary"])
def test_grain_gives_the_same_rollups(spark, sf, name):
    build = rollups.ADS_TABLES.get(name, rollups.daily_summary)
    df = fact_from_events(spark, sf).withColumns({
        "repo_id": F.when(F.hour("event_ts") != 3, F.col("repo_id")), "language": F.lit(None).cast("string"),
        "event_ts": F.when(F.hour("event_ts") != 9, F.date_trunc("hour", "event_ts"))})
    grain = rollups.daily_grain(df.unionByName(df.limit(500)))
    assert grain.count() < grain.agg(F.sum("events")).first()[0]
    assert rows(build(grain)) == rows(build(df.unionByName(df.limit(500))))


def test_range_distinct_is_exact(spark, sf):
    df = fact_from_events(spark, sf).withColumn("repo_id", F.when(F.col("repo_id") % 3 == 0, -F.col("repo_id") * 100_003).otherwise(F.col("repo_id")))
    bitmaps, summary = rollups.distinct_days(df), rollups.daily_summary(df)
    for first, last in [(None, None), ("2024-01-03", "2024-01-09"), ("2030-01-01", None)]:
        own = reports.between(df, first, last, "dt")
        want = own.agg(F.count("*"), F.count_distinct("dt"), F.count_distinct("repo_id"), F.count_distinct("actor_id")).first()
        assert tuple(reports.range_distinct(bitmaps, summary, first, last).first()) == tuple(want)


def test_sketches_stay_within_their_error(spark, sf):
    df = fact_from_events(spark, sf).unionByName(fact_from_events(spark, sf).withColumn("repo_id", F.xxhash64("event_id")))
    got = {r.event_type: r for r in reports.range_estimates(rollups.sketch_days(df), "2024-01-02", "2024-01-20").collect()}
    for r in reports.between(df, "2024-01-02", "2024-01-20", "dt").groupBy("event_type").agg(
            F.count("*").alias("n"), F.count_distinct("repo_id").alias("repos"), F.count_distinct("actor_id").alias("actors")).collect():
        own = got[r.event_type]
        assert own.events == r.n and abs(own.repos - r.repos) <= 0.03 * r.repos and abs(own.actors - r.actors) <= 0.03 * r.actors


@pytest.mark.parametrize("name", list(rollups.RANK_TIES))
def test_top_rows_are_cut_before_the_shuffle(spark, sf, name):
    plan = physical(rollups.top_rank_per_day(fact_from_events(spark, sf), name, rows=3))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_columns(spark):
    df = fact(spark, {})
    assert {name: build(df).columns for name, build in rollups.ADS_TABLES.items()} == {
        "daily_event_type": ["date", "event_type", "event_cnt", "actor_cnt"],
        "daily_repo_rank": ["date", "repo_id", "repo_name", "event_cnt", "actor_cnt", "push_cnt", "star_cnt",
                            "fork_cnt", "pr_cnt", "issue_cnt"],
        "daily_actor_active": ["date", "actor_id", "actor_login", "event_cnt", "repo_cnt", "push_cnt", "pr_cnt",
                               "issue_cnt"],
        "daily_org_rank": ["date", "org_login", "event_cnt", "repo_cnt", "actor_cnt"],
        "hourly_activity": ["date", "hour", "event_cnt", "actor_cnt", "repo_cnt"],
        "daily_pr_funnel": ["date", "opened_cnt", "merged_cnt", "closed_cnt", "reopened_cnt", "total_cnt",
                            "repo_cnt", "actor_cnt", "merge_rate"]}


def test_funnel_rate(spark):
    pr = {"event_type": "PullRequestEvent"}
    df = fact(spark, pr | {"pr_action": "opened"}, pr | {"pr_action": "merged"}, pr | {"pr_action": "merged"},
              pr | {"pr_action": "closed"}, pr | {"pr_action": None},
              pr | {"pr_action": "opened", "dt": D15}, {"dt": dt.date(2024, 1, 16)})
    got = {r.date: r for r in rollups.daily_pr_funnel(df).collect()}
    assert set(got) == {D14, D15}
    assert (got[D14].opened_cnt, got[D14].merged_cnt, got[D14].closed_cnt, got[D14].total_cnt) == (1, 2, 1, 5)
    assert (got[D14].merge_rate, got[D15].merge_rate) == (0.6667, None)


def test_org_rank_skips_events_without_organisation(spark):
    got = rollups.daily_org_rank(fact(spark, {}, {"org_login": "acme"}))
    assert [tuple(r) for r in got.collect()] == [(D14, "acme", 1, 1, 1)]


def test_missing_time_is_an_hour_of_its_own(spark):
    got = rollups.hourly_activity(fact(spark, {}, {"event_ts": None}))
    assert {(r.hour, r.event_cnt) for r in got.collect()} == {(5, 1), (None, 1)}


def test_totals_agree(spark, sf):
    df = fact_from_events(spark, sf)
    total = df.count()
    for table, measure in [(rollups.daily_event_type(df), "event_cnt"), (rollups.hourly_activity(df), "event_cnt"),
                           (rollups.daily_summary(df), "events"), (rollups.daily_repo_rank(df), "event_cnt"),
                           (rollups.daily_actor_active(df), "event_cnt")]:
        assert table.agg(F.sum(measure)).first()[0] == total


def test_top_per_day_is_limited_before_the_shuffle(spark, sf):
    df = rollups.top_per_day(rollups.daily_org_rank(fact_from_events(spark, sf)), "org_login", rows=3)
    assert df.groupBy("date").count().agg(F.max("count")).first()[0] <= 3
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = physical(rollups.top_per_day(rollups.daily_org_rank(fact_from_events(spark, sf)), "org_login", rows=3))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    final, partial = plan.index("Final"), plan.index("Partial")
    assert "Exchange" in plan[final:partial]


def test_distinct_counts_shuffle_by_the_counted_value(spark, sf):
    """A day that holds most of the rows is spread over tasks."""
    plan = physical(rollups.daily_event_type(fact_from_events(spark, sf)))
    deepest = plan[plan.rindex("Exchange hashpartitioning"):].split("\n")[0]
    assert "user_id" in deepest or "actor_id" in deepest


def test_rollups_read_only_their_columns(spark, sf):
    plan = plan_of(rollups.daily_summary(fact_from_events(spark, sf)))
    assert "value" not in plan[plan.index("ReadSchema"):]


def test_meta(spark, sf):
    meta = rollups.dataset_meta(rollups.daily_summary(fact_from_events(spark, sf)), "demo").first()
    assert (meta.days, meta.kind) == (30, "demo") and meta.built_at is not None
