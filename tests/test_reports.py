import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import physical
from tidemark.operators import rollups, texts
from tidemark.plans import reports
from tidemark.sources.adapter import fact_from_events

D = [dt.date(2024, 1, d) for d in (1, 2, 3)]


def test_range_is_closed_and_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(d, 1) for d in D], "date date, n int").write.partitionBy("date").parquet(path)
    df = reports.between(spark.read.parquet(path), D[0], "2024-01-02")
    assert df.count() == 2
    assert "PartitionFilters: [isnotnull(date" in physical(df)
    assert reports.on_dates(spark.read.parquet(path), [D[2]]).count() == 1


def test_last_full_days(spark):
    df = spark.range(0, 10).select(F.date_sub(F.current_date(), F.col("id").cast("int")).alias("date"))
    got = reports.last_full_days(df, 3).select(F.datediff(F.current_date(), "date").alias("ago"))
    assert sorted(r.ago for r in got.collect()) == [1, 2, 3]


def test_mix_keeps_leading_types(spark):
    table = spark.createDataFrame(
        [(D[0], "A", 5), (D[0], "B", 3), (D[0], "C", 1), (D[1], "C", 1), (D[1], "D", 2)],
        "date date, event_type string, event_cnt long")
    got = {(r.date, r.kind): r.cnt for r in reports.event_mix(table, top=2).collect()}
    assert got == {(D[0], "A"): 5, (D[0], "B"): 3, (D[0], "other"): 1, (D[1], "other"): 3}


LOGINS = [("x[bot]", 9), ("x-bot", 8), ("robot", 7), ("ann", 6), (None, 5)]


def test_bots(spark):
    table = spark.createDataFrame([(D[0], n, c, 1) for n, c in LOGINS],
                                  "date date, actor_login string, event_cnt long, repo_cnt long")
    humans = reports.contributor_leaderboard(table)
    assert [(r.actor_login, r.events) for r in humans.collect()] == [("robot", 7), ("ann", 6)]
    everyone = reports.contributor_leaderboard(table, hide_bots=False, top=3)
    assert [r.actor_login for r in everyone.collect()] == ["x[bot]", "x-bot", "robot"]
    assert [tuple(r) for r in reports.bot_share(table).collect()] == [("human", 18, 51.43), ("bot", 17, 48.57)]


def test_ties_are_ordered_by_name(spark):
    table = spark.createDataFrame([(D[0], n, 1, 1, 1) for n in "cab"],
                                  "date date, repo_name string, event_cnt long, star_cnt long, pr_cnt long")
    assert [r.repo_name for r in reports.repo_leaderboard(table, top=2).collect()] == ["a", "b"]


def test_heatmap(spark):
    table = spark.createDataFrame([(D[0], 0, 4), (D[0], 23, 9), (D[1], 5, 9), (D[1], 6, 0)],
                                  "date date, hour int, event_cnt long")
    heat = reports.hour_heatmap(table)
    wide = reports.hour_heatmap_wide(heat).orderBy("date").collect()
    assert len(wide[0]) == 25 and (wide[0].h00, wide[0].h01, wide[0].h23) == (4, 0, 9)
    assert tuple(reports.peak_trough(heat).first()) == (D[0], 23, 9, D[1], 6, 0, 9.0)


def test_funnel(spark):
    table = spark.createDataFrame([(D[0], 3, 2, 1), (D[1], 1, 0, 0)],
                                  "date date, opened_cnt long, merged_cnt long, closed_cnt long")
    series = reports.funnel_series(table)
    assert [tuple(r) for r in series.collect()] == [(D[0], 3, 2, 1, 0.6667), (D[1], 1, 0, 0, None)]
    assert {(r.date, r.action, r.n) for r in reports.funnel_long(series).collect()} == {
        (D[0], "opened", 3), (D[0], "merged", 2), (D[0], "closed", 1),
        (D[1], "opened", 1), (D[1], "merged", 0), (D[1], "closed", 0)}


def test_unused_measures_are_not_computed(spark, sf):
    plan = physical(reports.repo_leaderboard(rollups.daily_repo_rank(fact_from_events(spark, sf))))
    assert "distinct" not in plan and "user_id" not in plan and "TakeOrderedAndProject" in plan


def test_share_scans_once(spark, sf):
    plan = physical(reports.bot_share(rollups.daily_actor_active(fact_from_events(spark, sf))))
    assert plan.count("FileScan") == 1


ROUTES = [
    ("每小时什么时段最活跃", "events_by_hour", 8),
    ("哪些机器人最多", "bot_share", 5),
    ("PR 合并率怎么样", "daily_merge_rate", 12),
    ("Show MERGE and push", "daily_merge_rate", 7),
    ("push or bot", "event_type_totals", 6),
    ("用户和公司", "top10_orgs", 4),
    ("hello", None, None),
    ("", None, None),
    (None, None, None),
]


@pytest.mark.parametrize("text, topic, score", ROUTES)
def test_keyword_route(spark, text, topic, score):
    got = texts.keyword_route(spark.createDataFrame([(text,)], "text string")).first()
    assert (got.topic, got.score) == (topic, score)


def test_route_is_a_projection(spark):
    df = texts.keyword_route(spark.createDataFrame([("a",)], "text string"))
    assert "Join" not in physical(df) and "Exchange" not in physical(df)


def test_topics_are_the_questions():
    assert list(reports.QUESTIONS) == list(texts.fixed.QUESTION_TOPICS)


@pytest.mark.parametrize("text, statement, reason", [
    ("select offset from t", "select offset from t", None),
    ("select 1; drop table x", "select 1; drop table x", "forbidden word"),
    ("", "", "empty"),
    (None, "", "empty"),
    ("  \n", "", "empty"),
    ("```sql\nSELECT 1;\n```", "SELECT 1", None),
    ("```\nwith a as (select 1) select * from a\n```", "with a as (select 1) select * from a", None),
    ("Here you are: select 1 ;  ", "select 1", None),
    ("select 'drop'", "select 'drop'", "forbidden word"),
    ("show tables", "show tables", "not a query"),
    ("selected", "selected", "not a query"),
    ("éselect 1", "éselect 1", "not a query"),
    ("UPDATE t SET a = 1", "UPDATE t SET a = 1", "forbidden word"),
    ("select \u017fet", "select \u017fet", "forbidden word"),
    ("select a_set, setting from t", "select a_set, setting from t", None),
    ("```sql select 1 ``` trailing", "select 1 ``` trailing", None),
    ("reset and select settings", "select settings", None),
])
def test_sql_text_audit(spark, text, statement, reason):
    got = texts.sql_text_audit(spark.createDataFrame([(text,)], "text string")).first()
    assert (got.statement, got.reason, got.safe) == (statement, reason, reason is None)


def test_answer_cap(spark):
    assert texts.capped_answer(spark.range(500)).count() == 200
