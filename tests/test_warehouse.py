import datetime as dt
import gzip
import threading
import time
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.conftest import physical, rows
from tidemark.operators import rollups
from tidemark.operators.fact import fact_from_ods
from tidemark.plans import catalog, reports, warehouse
from tidemark.session import delete, side_by_side
from tidemark.sources import tables, versions
from tidemark.sources.adapter import ods_from_events, raw_lines_from_events


@pytest.fixture(scope="module")
def root(spark, sf):
    return catalog._warehouse(spark, sf)


@pytest.fixture
def ods(spark, sf, tmp_path):
    path = str(tmp_path / "ods")
    tables.write_days(ods_from_events(spark, sf).filter("dt < '2024-01-05'"), path, "dt", "hour")
    return path


def test_pipeline_equals_direct_queries(spark, sf, root):
    fact = fact_from_ods(ods_from_events(spark, sf))
    stored = versions.read_table(spark, root, "dwd", "event_fact")
    assert rows(stored.select(fact.columns)) == rows(fact)
    for name, build in rollups.ADS_TABLES.items():
        want = build(fact)
        assert rows(versions.read_table(spark, root, "ads", name).select(want.columns)) == rows(want), name


def test_views_answer_sql(spark, root):
    versions.register_views(spark, root).collect()
    total = spark.sql("SELECT sum(event_cnt) FROM ads_daily_event_type").first()[0]
    assert total == spark.sql("SELECT count(*) FROM dwd_event_fact").first()[0]
    assert {(r.layer, r.table) for r in tables.list_views(spark).collect()} == set(tables.LAYOUT)
    assert rows(reports.scale_overview(spark.table("dwd_event_fact"))) == rows(spark.sql(
        "SELECT count(*), count(DISTINCT repo_id), count(DISTINCT actor_id), count(DISTINCT dt) FROM dwd_event_fact"))


def test_missing_table_is_reported_and_has_no_view(spark, root, tmp_path):
    layout = [("ads", "daily_event_type"), ("ads", "absent")]
    got = {r.table: (r.rows, r.status) for r in versions.register_views(spark, root, layout).collect()}
    assert got["absent"] == (None, "missing") and got["daily_event_type"][1] == "ready"
    assert not spark.catalog.tableExists("ads_absent")


def test_fact_days_are_incremental_and_repeatable(spark, ods, tmp_path):
    fact = str(tmp_path / "fact")
    assert warehouse.build_fact_days(spark, ods, fact, days=[dt.date(2024, 1, 2)]) == [dt.date(2024, 1, 2)]
    once = sorted(p.name for p in Path(fact).rglob("*.parquet"))
    assert warehouse.build_fact_days(spark, ods, fact) == [dt.date(2024, 1, d) for d in (1, 3, 4)]
    assert set(once) <= {p.name for p in Path(fact).rglob("*.parquet")}
    want = rows(spark.read.parquet(fact))
    warehouse.build_fact_days(spark, ods, fact, days=[dt.date(2024, 1, 2)])
    assert rows(spark.read.parquet(fact)) == want
    assert warehouse.build_fact_days(spark, ods, fact) == []
    assert len(warehouse.build_fact_days(spark, ods, fact, overwrite=True)) == 4
    assert rows(spark.read.parquet(fact)) == want


def test_day_filter_prunes_partitions(spark, ods):
    df = fact_from_ods(spark.read.parquet(ods).filter(F.col("dt") == F.lit("2024-01-02").cast("date")))
    assert "PartitionFilters: [isnotnull(dt" in physical(df)


def test_extract(spark, root, tmp_path):
    out = str(tmp_path / "extract")
    got = {r.table: r for r in warehouse.write_extract(spark, root, out, rows=2).collect()}
    assert got["daily_org_rank"].rows == 60 < got["daily_org_rank"].full_rows
    assert got["daily_pr_funnel"].pct == 100.0
    assert versions.read_table(spark, out, "serving", "meta").first().kind == "demo"
    assert rows(versions.read_table(spark, out, "serving", "summary")) == rows(
        versions.read_table(spark, root, "serving", "summary"))


def test_small_tables_are_one_file(root):
    for layer, name in [("dwd", "dim_repo"), ("dwd", "dim_actor"), ("dwd", "dim_date"), ("serving", "meta")]:
        assert len(list(Path(tables.table_path(root, layer, name)).glob("run=*/*.parquet"))) == 1
    for name in rollups.ADS_TABLES:
        for day in Path(tables.table_path(root, "ads", name)).glob("run=*/date=*"):
            assert len(list(day.glob("*.parquet"))) == 1


def test_table_size(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(70), path)
    size = tables.table_size(spark, path).first()
    assert (size.rows, size.files) == (70, 1)
    assert size.bytes == sum(p.stat().st_size for p in Path(path).glob("*.parquet"))


def test_quality_report(spark, root, tmp_path):
    got = warehouse.write_quality_report(spark, root, str(tmp_path / "dq")).first()
    assert (got.total, got.blocking_failed, got.gate_open) == (5, 0, True)
    assert got.failed == 1  # the smallest tables do not fill all hours of each day


def _files(root):
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet") if "versions" not in p.parts}


def _agrees(spark, root, ods):
    """All tables of the version in use equal those built straight from the whole fact."""
    whole = fact_from_ods(spark.read.parquet(ods).drop("file", "raw_path"))
    read = lambda layer, name: versions.read_table(spark, root, layer, name)
    assert rows(read("dwd", "event_fact").select(whole.columns)) == rows(whole)
    for name, build in rollups.ADS_TABLES.items():
        want = build(whole)
        assert rows(read("ads", name).select(want.columns)) == rows(want), name
    for name, build in warehouse.DIMENSIONS.items():
        want = build(whole)
        assert rows(read("dwd", name).select(want.columns)) == rows(want), name
    assert rows(read("serving", "summary").select("date", "events", "repos", "actors")) == rows(rollups.daily_summary(whole))


def test_only_changed_days_are_built(spark, ods, tmp_path):
    root = str(tmp_path / "w")
    assert warehouse.build_from(spark, ods, root) == ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
    built = _files(root)
    assert warehouse.build_from(spark, ods, root) == [] and _files(root) == built and versions.numbers(spark, root) == [1]

    late = spark.read.parquet(ods).filter("dt = '2024-01-03' and hour = 5").withColumn("hour", F.lit(30))
    tables.write_days(late.withColumn("event_id", F.concat(F.lit("late"), "event_id")), ods, "dt", "hour")
    assert warehouse.build_from(spark, ods, root) == ["2024-01-03"]
    new = set(_files(root)) - set(built)
    assert {p.parent.name for p in map(Path, new) if "=2024" in p.parent.name} == {"dt=2024-01-03", "date=2024-01-03"}
    assert {p: t for p, t in _files(root).items() if p in built} == built
    _agrees(spark, root, ods)
    assert "PartitionFilters: [isnotnull(date" in physical(
        reports.between(versions.read_table(spark, root, "ads", "daily_repo_rank"), "2024-01-02", "2024-01-03"))


def test_days_that_empty_or_shrink_leave_all_tables(spark, ods, tmp_path):
    """Dimensions take back the share of a day that was built anew, went empty or went away."""
    root = str(tmp_path / "w")
    warehouse.build_from(spark, ods, root)
    for hour in Path(ods).glob("dt=2024-01-02/hour=*"):
        if hour.name != "hour=7":
            delete(spark, str(hour))
    delete(spark, f"{ods}/dt=2024-01-04")
    out_of_scope = spark.read.parquet(ods).filter("dt = '2024-01-01'").withColumn("event_type", F.lit("Unknown"))
    tables.write_days(out_of_scope.limit(20).repartition(1), f"{ods}_new", "dt", "hour")
    delete(spark, f"{ods}/dt=2024-01-01")
    tables.write_days(spark.read.parquet(f"{ods}_new"), ods, "dt", "hour")
    assert warehouse.build_from(spark, ods, root) == ["2024-01-01", "2024-01-02"]
    _agrees(spark, root, ods)
    assert {str(r.date) for r in versions.read_table(spark, root, "ads", "hourly_activity").select("date").distinct().collect()} == {
        "2024-01-02", "2024-01-03"}
    listed = {(r.layer, r.name): (r.days, r.empty_days) for r in versions.listing(spark, root).collect()}
    assert listed["dwd", "event_fact"] == (2, 1) and listed["ads", "daily_org_rank"] == (2, 1)


def test_old_versions_are_read_until_they_are_vacuumed(spark, ods, tmp_path):
    root = str(tmp_path / "w")
    warehouse.build_from(spark, ods, root)
    before = rows(versions.read_table(spark, root, "ads", "daily_pr_funnel"))
    more = spark.read.parquet(ods).filter("dt = '2024-01-03'").withColumn("hour", F.lit(31))
    tables.write_days(more, ods, "dt", "hour")
    warehouse.build_from(spark, ods, root)
    old = versions.current(spark, root, 1)
    assert rows(versions.read(spark, root, "ads", "daily_pr_funnel", old)) == before
    assert rows(versions.read_table(spark, root, "ads", "daily_pr_funnel")) != before
    assert versions.vacuum(spark, root, keep=2) == 0
    assert versions.vacuum(spark, root, keep=1) > 0 and versions.numbers(spark, root) == [2]
    _agrees(spark, root, ods)


def test_a_race_has_one_winner(spark, ods, tmp_path):
    root = str(tmp_path / "w")
    warehouse.build_from(spark, ods, root)
    more = spark.read.parquet(ods).filter("dt = '2024-01-03'").withColumn("hour", F.lit(31))
    tables.write_days(more, ods, "dt", "hour")
    slow = versions.Draft(spark, root)
    warehouse.build_fact(slow, spark.read.parquet(ods), tables.day_prints(spark, ods))
    warehouse.build_from(spark, ods, root)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        slow.commit()
    slow.abandon()
    _agrees(spark, root, ods)


def test_an_hour_that_lands_during_the_job_is_built_by_the_next(spark, ods, tmp_path, monkeypatch):
    fact, build = str(tmp_path / "fact"), warehouse.fact_from_ods
    late = spark.read.parquet(ods).filter("dt = '2024-01-03'").withColumn("hour", F.lit(31))

    def landing_meanwhile(source):
        made = build(source)
        tables.write_days(late, ods, "dt", "hour")
        return made

    monkeypatch.setattr(warehouse, "fact_from_ods", landing_meanwhile)
    assert len(warehouse.build_fact_days(spark, ods, fact)) == 4
    monkeypatch.setattr(warehouse, "fact_from_ods", build)
    assert warehouse.build_fact_days(spark, ods, fact) == [dt.date(2024, 1, 3)]
    whole = fact_from_ods(spark.read.parquet(ods))
    assert rows(spark.read.parquet(fact).select(whole.columns)) == rows(whole)


def test_a_fact_day_that_is_asked_for_and_empties(spark, ods, tmp_path):
    fact = str(tmp_path / "fact")
    warehouse.build_fact_days(spark, ods, fact)
    delete(spark, f"{ods}/dt=2024-01-02")
    assert warehouse.build_fact_days(spark, ods, fact) == [dt.date(2024, 1, 2)]
    assert {str(r.dt) for r in spark.read.parquet(fact).select("dt").distinct().collect()} == {
        "2024-01-01", "2024-01-03", "2024-01-04"}
    assert warehouse.build_fact_days(spark, ods, fact) == []


def _zone(spark, sf, path, last="2024-01-02"):
    lines = raw_lines_from_events(spark, sf).filter(F.col("dt") <= last).hint("rebalance", "dt", "hour")
    lines.write.partitionBy("dt", "hour").option("compression", "gzip").text(path)


def test_a_closed_gate_changes_nothing(spark, sf, tmp_path):
    raw_root, root = str(tmp_path / "raw"), str(tmp_path / "w")
    _zone(spark, sf, raw_root)
    warehouse.build_warehouse(spark, raw_root, root)
    before, fact = _files(root), rows(versions.read_table(spark, root, "dwd", "event_fact"))
    bad = Path(raw_root, "dt=2024-01-03", "hour=0")
    bad.mkdir(parents=True)
    sound = '{"id": "%s", "type": "PushEvent", "actor": {"id": 1, "login": "a"}, "repo": {"id": 2, "name": "o/r"}, "created_at": "2024-01-03T00:00:00Z"}\n'
    (bad / "one.json.gz").write_bytes(gzip.compress((sound % "new" + sound % "").encode()))
    with pytest.raises(warehouse.GateClosed, match="R1") as closed:
        warehouse.build_warehouse(spark, raw_root, root)
    assert [r.passed for r in closed.value.rules][0] is False and len(closed.value.rules) == 5
    assert _files(root) == before and rows(versions.read_table(spark, root, "dwd", "event_fact")) == fact
    with pytest.raises(warehouse.GateClosed):  # the file is still due
        warehouse.build_warehouse(spark, raw_root, root)
    (bad / "one.json.gz").write_bytes(gzip.compress((sound % "new").encode()))
    status = {r.table: r.rows for r in warehouse.build_warehouse(spark, raw_root, root).collect()}
    assert status["event_fact"] == len(fact) + 1 and versions.numbers(spark, root) == [1, 2]
    _agrees(spark, root, f"{root}/ods/events")
    built = _files(root)
    warehouse.build_warehouse(spark, raw_root, root)
    assert _files(root) == built


def test_a_gate_that_is_left_open(spark, sf, tmp_path):
    raw_root, root = str(tmp_path / "raw"), str(tmp_path / "w")
    (tmp_path / "raw" / "dt=2024-01-03" / "hour=0").mkdir(parents=True)
    (tmp_path / "raw" / "dt=2024-01-03" / "hour=0" / "x.json.gz").write_bytes(gzip.compress(b'{"type": "PushEvent"}\n'))
    status = {r.table: r.status for r in warehouse.build_warehouse(spark, raw_root, root, gate=False).collect()}
    assert status["events"] == "ready" and status["event_fact"] == "missing"  # no row is in scope


def test_questions(spark, root):
    got = warehouse.answer(spark, root, "机器人 bot 占多少？")
    assert got.columns == ["kind", "events", "pct"] and got.count() == 2
    assert warehouse.answer(spark, root, "数据量").first().days == 30
    assert warehouse.answer(spark, root, "nothing of the kind") is None


def test_statements(spark, root):
    versions.register_views(spark, root)
    got = warehouse.run_statement(spark, "```sql\nSELECT date, event_cnt FROM ads_daily_repo_rank;\n```")
    assert got.count() == 200
    with pytest.raises(ValueError, match="forbidden word"):
        warehouse.run_statement(spark, "DROP VIEW ads_daily_repo_rank")
    with pytest.raises(ValueError, match="empty"):
        warehouse.run_statement(spark, " ")


@pytest.mark.parametrize("text, reason", [
    ("SELECT " + ", ".join(f"{i} AS c{i}" for i in range(40)) + ", `java_method`('java.lang.System', 'getProperty', 'user.home')", "function"),
    ("SELECT 'CTE [secret]' AS a, v FROM secret", "not a registered view"),
    ("SELECT * FROM (SELECT /* ads_daily_org_rank */ v FROM secret) x", "not a registered view"),
    ("SELECT date FROM ads_daily_org_rank WHERE event_cnt > (SELECT max(v) FROM secret)", "not a registered view"),
    ("WITH a AS (SELECT v FROM secret) SELECT * FROM a", "not a registered view"),
    ("WITH a AS (SELECT reflect('java.lang.System', 'getenv') AS v) SELECT * FROM a", "function"),
    ("SELECT date FROM ads_daily_org_rank WHERE org_login IN (SELECT try_reflect('a', 'b'))", "function"),
    ("SELECT input_file_name(), date FROM ads_daily_org_rank", "function"),
    ("SELECT IDENTIFIER('java_method')('java.lang.System', 'lineSeparator')", "names made|function|expression"),
    ("SELECT * FROM range(10)", "table functions"),
    ("SELECT * FROM parquet.`{path}`", "not a registered view"),
    ("SELECT * FROM IDENTIFIER('secret')", "names made"),
])
def test_statements_that_reach_out_are_refused(spark, root, tmp_path, text, reason):
    versions.register_views(spark, root)
    path = str(tmp_path / "secret")
    spark.createDataFrame([(1,)], "v int").write.parquet(path)
    spark.sql(f"CREATE TABLE IF NOT EXISTS secret USING parquet AS SELECT 1 AS v")
    try:
        with pytest.raises(ValueError, match=f"refused: ({reason})"):
            warehouse.run_statement(spark, text.replace("{path}", path))
    finally:
        spark.sql("DROP TABLE IF EXISTS secret")


def test_statements_that_compute_are_run(spark, root):
    versions.register_views(spark, root)
    got = warehouse.run_statement(spark, """
        WITH d AS (SELECT date, sum(event_cnt) AS n, collect_set(event_type) AS kinds FROM ads_daily_event_type GROUP BY date)
        SELECT a.date, n, size(kinds) AS k, row_number() OVER (ORDER BY n DESC, a.date) AS place, 'reflect(' AS text,
               upper(concat('x', cast(n AS string))) AS label
        FROM d a JOIN (VALUES (date'2024-01-02'), (date'2024-01-03')) v(date) ON v.date = a.date
        WHERE EXISTS (SELECT 1 FROM serving_summary s WHERE s.date = a.date) ORDER BY place""")
    assert [r.place for r in got.collect()] == [1, 2]


def test_a_table_that_cannot_be_read_is_told(spark, tmp_path):
    out = str(tmp_path / "w")
    spark.range(5).withColumn("date", F.lit("2024-01-01").cast("date")).write.parquet(f"{out}/ads/daily_event_type")
    for file in Path(out, "ads", "daily_event_type").glob("*.parquet"):
        file.write_bytes(file.read_bytes()[:30])
    got = {r.table: r.status for r in versions.register_views(spark, out, [("ads", "daily_event_type")]).collect()}
    assert got == {"daily_event_type": "unreadable"} and not spark.catalog.tableExists("ads_daily_event_type")


def test_sample_export(spark, root, tmp_path):
    path = str(tmp_path / "sample")
    tables.export_sample(versions.read_table(spark, root, "dwd", "event_fact"), path, "event_id", "event_type", rows=7)
    sample = spark.read.parquet(path)
    assert (sample.count(), sample.columns) == (7, ["event_id", "event_type"])


def test_tables_of_one_origin_are_built_side_by_side(spark, ods, tmp_path, monkeypatch):
    """Two tables made of the grain wait for each other, which only ends where both are under way."""
    both, met = threading.Barrier(2), set()

    def waits(name):
        build = rollups.ADS_TABLES[name]

        def run(rows):
            both.wait(60)
            met.add(name)
            return build(rows)
        return run

    for name in ("daily_event_type", "hourly_activity"):
        monkeypatch.setitem(warehouse.DAY_TABLES, ("ads", name), (("state", "event_grain"), waits(name)))
    warehouse.build_from(spark, ods, str(tmp_path / "lake"))
    assert met == {"daily_event_type", "hourly_activity"}
    assert versions.read_table(spark, str(tmp_path / "lake"), "ads", "hourly_activity").count() > 0


def test_a_step_that_fails_waits_for_the_others(spark):
    ended = []

    def slow():
        time.sleep(0.5)
        ended.append(1)

    with pytest.raises(ZeroDivisionError):
        side_by_side(spark, [lambda: 1 / 0, slow])
    assert ended == [1] and side_by_side(spark, [lambda: 1, lambda: 2]) == [1, 2]
