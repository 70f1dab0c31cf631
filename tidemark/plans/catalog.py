"""Every registered query as ``(spark, sf_dir) -> DataFrame`` over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import fixed
from tidemark.operators import dims, profile, quality, rollups, texts
from tidemark.operators.fact import build_fact, fact_from_ods, in_scope, parse_payload
from tidemark.plans import reports, warehouse
from tidemark.session import pin_utc, scratch_dir
from tidemark.sources import raw, tables, versions
from tidemark.sources.adapter import fact_from_events, ods_from_events, raw_lines_from_events
from tidemark.streaming.landing import land_stream

Query = Callable[[SparkSession, str], DataFrame]

# Phrases the routing query looks for in the given conversations.
CONVERSATION_TOPICS = {
    "english": ["the ", "and", "ing", "that", "with"],
    "french": ["les ", "eau", "une", "que", "ment"],
    "german": ["der ", "die ", "und", "sch", "keit"],
    "code": ["def ", "select", "merge", "push", "bot"],
}


def _table(name: str) -> Query:
    return lambda spark, sf_dir: spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fact(op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: op(fact_from_events(spark, sf_dir))


def _ods(op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: op(ods_from_events(spark, sf_dir))


def _full_fact(op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: op(fact_from_ods(ods_from_events(spark, sf_dir)))


def _on(name: str, op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: op(_table(name)(spark, sf_dir))


#: Files written for the queries that read stored tables, once per application and source.
_WRITTEN: dict[tuple[str, str, str], str] = {}


def _once(label: str):
    def wrap(write: Callable[[SparkSession, str, str], None]) -> Callable[[SparkSession, str], str]:
        def path_of(spark: SparkSession, sf_dir: str) -> str:
            key = (spark.sparkContext.applicationId, sf_dir, label)
            if key not in _WRITTEN:
                path = scratch_dir(spark, label)
                write(spark, sf_dir, path)
                _WRITTEN[key] = path
            return _WRITTEN[key]
        return path_of
    return wrap


@_once("dimensions")
def _dimensions(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The dimensions as stored tables: written once, then looked up."""
    fact = fact_from_ods(ods_from_events(spark, sf_dir))
    for name, build in warehouse.DIMENSIONS.items():
        tables.write_table(build(fact), f"{path}/{name}")


def _rollup_queries() -> dict[str, Query]:
    return {
        "daily_event_type": _fact(rollups.daily_event_type),
        "daily_repo_rank": _fact(rollups.daily_repo_rank),
        "daily_repo_rank_exact": _fact(lambda f: rollups.daily_repo_rank(f, exact=True)),
        "daily_actor_active": _fact(rollups.daily_actor_active),
        "daily_org_rank": _fact(rollups.daily_org_rank),
        "hourly_activity": _fact(rollups.hourly_activity),
        "daily_pr_funnel": _fact(rollups.daily_pr_funnel),
        "daily_summary": _fact(rollups.daily_summary),
        "dataset_meta": _fact(lambda f: rollups.dataset_meta(rollups.daily_summary(f)).drop("built_at")),
        "topn_repo_per_day": _fact(
            lambda f: rollups.top_rank_per_day(f, "daily_repo_rank", rows=20)),
        "topn_actor_per_day": _fact(
            lambda f: rollups.top_rank_per_day(f, "daily_actor_active", rows=20)),
        "topn_org_per_day": _fact(
            lambda f: rollups.top_rank_per_day(f, "daily_org_rank", rows=3)),
        "orders_daily_funnel": _on("orders", _orders_funnel),
        "topn_part_per_day": _on("lineitem", _top_parts),
    }


def _orders_funnel(orders: DataFrame) -> DataFrame:
    status = F.create_map(*map(F.lit, ["O", "opened", "F", "merged", "P", "closed"]))
    rows = orders.select(F.to_date("o_orderdate").alias("day"), "o_custkey",
                         F.element_at(status, F.col("o_orderstatus")).alias("action"))
    return rollups.action_funnel(rows, "day", "action", {"customer_cnt": "o_custkey"})


def _top_parts(lineitem: DataFrame) -> DataFrame:
    rank = lineitem.groupBy(F.to_date("l_shipdate").alias("date"), F.col("l_partkey").alias("part_id")).agg(
        F.count("*").alias("event_cnt"))
    return rollups.top_per_day(rank, "part_id", rows=3)


def _fact_queries() -> dict[str, Query]:
    def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
        fact = fact_from_ods(ods_from_events(spark, sf_dir))
        lookups = [spark.read.parquet(f"{_dimensions(spark, sf_dir)}/{name}") for name in warehouse.DIMENSIONS]
        return dims.enrich_fact(fact, *lookups).select(
            "event_id", "event_type", "dt", "repo_id", "repo_name_now", "org_login_now", "repo_language",
            "actor_id", "actor_login_now", "week_of_year", "weekday", "is_weekend")

    return {
        "fact_payload_parsed": _ods(parse_payload),
        "fact_whitelisted": _full_fact(lambda f: f),
        "fact_action_columns": _full_fact(
            lambda f: f.select("event_id", "event_type", "pr_action", "issue_action", "release_action")),
        "payload_language": _full_fact(lambda f: f.groupBy("event_type", "language").agg(
            F.count("*").alias("event_cnt"))),
        "dim_repo": _full_fact(dims.dim_repo),
        "dim_actor": _full_fact(dims.dim_actor),
        "dim_date": _fact(dims.dim_date),
        "fact_enriched": enriched,
    }


def _report_queries() -> dict[str, Query]:
    # Ranges are open at both ends: all days that there are.
    def over(rollup: Callable[[DataFrame], DataFrame], report: Callable, **args) -> Query:
        return _fact(lambda f: report(rollup(f), **args))

    heat = lambda f: reports.hour_heatmap(rollups.hourly_activity(f))
    series = lambda f: reports.funnel_series(rollups.daily_pr_funnel(f))
    out = {
        "available_dates": over(rollups.daily_event_type, reports.available_dates),
        "kpi_range": over(rollups.daily_summary, reports.kpi_range),
        "event_mix_top7": over(rollups.daily_event_type, reports.event_mix, top=7),
        "event_mix_top3": over(rollups.daily_event_type, reports.event_mix, top=3),
        "repo_leaderboard": over(rollups.daily_repo_rank, reports.repo_leaderboard),
        "contributor_leaderboard": over(rollups.daily_actor_active, reports.contributor_leaderboard, hide_bots=True),
        "contributor_leaderboard_all": over(
            rollups.daily_actor_active, reports.contributor_leaderboard, hide_bots=False),
        "org_leaderboard": over(rollups.daily_org_rank, reports.org_leaderboard),
        "hour_heatmap": _fact(heat),
        "hour_heatmap_wide": _fact(lambda f: reports.hour_heatmap_wide(heat(f))),
        "peak_trough": _fact(lambda f: reports.peak_trough(heat(f))),
        "funnel_series": _fact(series),
        "funnel_long": _fact(lambda f: reports.funnel_long(series(f))),
        "range_distinct": _fact(lambda f: reports.range_distinct(rollups.distinct_days(f), rollups.daily_summary(f))),
        "range_distinct_week": _fact(lambda f: reports.range_distinct(
            rollups.distinct_days(f), rollups.daily_summary(f), "2024-01-08", "2024-01-14")),
        "last_full_days": _fact(lambda f: reports.last_full_days(rollups.daily_event_type(f), 7, today="2024-01-20")),
    }
    out["capped_answer"] = _fact(lambda f: texts.capped_answer(
        rollups.daily_repo_rank(f).orderBy("date", F.desc("event_cnt"), "repo_id", "repo_name")))
    for name, (table, report) in reports.QUESTIONS.items():
        out[name] = _fact(report) if table == "event_fact" else over(rollups.ADS_TABLES[table], report)
    return out


def _quality_queries() -> dict[str, Query]:
    def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
        return quality.quality_rules(ods_from_events(spark, sf_dir), fact_from_events(spark, sf_dir))

    return {
        "dq_not_null": _ods(lambda o: quality.null_audit(o, "event_id", "event_type", "created_at")),
        "dq_unique": _fact(lambda f: quality.duplicate_rate(f, "event_id")),
        "dq_hour_complete": _ods(quality.hour_completeness),
        "dq_volatility": _fact(quality.volatility),
        "dq_enum": _ods(lambda o: quality.unknown_values(o, "event_type", fixed.EVENT_TYPES)),
        "dq_report": rules,
        "dq_summary": lambda spark, sf_dir: quality.quality_summary(rules(spark, sf_dir)),
        "volatility_calibration": _fact(quality.volatility_calibration),
        "volume_spread": _fact(quality.volume_spread),
        "column_coverage": _full_fact(lambda f: quality.column_coverage(f, "language")),
        "filter_drop": _ods(lambda o: quality.filter_drop(o, in_scope())),
        "missing_hours": _ods(quality.missing_hours),
        "orders_missing_hours": _on("orders", lambda t: quality.missing_hours(
            t.select(F.to_date("o_orderdate").alias("dt"), F.hour("o_orderdate").alias("hour")))),
        "lineitem_duplicates": _on("lineitem", lambda t: quality.duplicate_rate(t, "l_orderkey", "l_linenumber")),
        "lineitem_volatility": _on("lineitem", lambda t: quality.volatility(
            t.select(F.to_date("l_shipdate").alias("dt")))),
        "lineitem_calibration": _on("lineitem", lambda t: quality.volatility_calibration(
            t.select(F.to_date("l_shipdate").alias("dt")))),
        "orders_hour_complete": _on("orders", lambda t: quality.hour_completeness(
            t.select(F.to_date("o_orderdate").alias("dt"), F.hour("o_orderdate").alias("hour")))),
    }


def _profile_queries() -> dict[str, Query]:
    return {
        "ods_profile": _ods(profile.ods_profile),
        "ods_null_audit": _ods(profile.ods_null_audit),
        "ods_duplicates": _ods(profile.ods_duplicates),
        "ods_hour_coverage": _ods(profile.ods_hour_coverage),
        "ods_by_day": _ods(profile.ods_by_day),
        "ods_type_share": _ods(profile.ods_type_share),
        "ods_top_repos": _ods(profile.ods_top_repos),
        "ods_payload_length": _ods(profile.mean_text_length),
        "document_text_length": _on("documents", lambda t: profile.mean_text_length(t, "text")),
    }


def _text_queries() -> dict[str, Query]:
    return {
        "keyword_route": _on("conversations", lambda t: texts.keyword_route(
            t, topics=CONVERSATION_TOPICS).drop("text")),
        "sql_text_audit": _on("documents", lambda t: texts.sql_text_audit(t).select(
            "doc_id", "safe", "reason", F.length("statement").alias("statement_chars"))),
    }


@_once("raw")
def _raw_zone(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The events as gzip files of JSON lines by day and hour, in the shared scratch folder."""
    lines = raw_lines_from_events(spark, sf_dir).hint("rebalance", "dt", "hour")
    lines.write.partitionBy("dt", "hour").option("compression", "gzip").text(path)


@_once("ods")
def _landed(spark: SparkSession, sf_dir: str, path: str) -> None:
    warehouse.land(spark, _raw_zone(spark, sf_dir), path)


@_once("warehouse")
def _warehouse(spark: SparkSession, sf_dir: str, path: str) -> None:
    warehouse.build_warehouse(spark, _raw_zone(spark, sf_dir), path)


def _pipeline_queries() -> dict[str, Query]:
    """Queries that go through files: written by Spark from the given tables, then read back."""

    def landed_ods(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.read.parquet(_landed(spark, sf_dir)).drop("raw_path", "file")

    def late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Each hour has two files, of which one comes after the hour was landed."""
        raw_root, ods_path = scratch_dir(spark, "raw"), scratch_dir(spark, "ods")
        lines = raw_lines_from_events(spark, sf_dir).withColumn("late", F.pmod(F.xxhash64("line"), F.lit(2)) == 1)
        for late in (False, True):
            part = lines.filter(F.col("late") == late).drop("late").hint("rebalance", "dt", "hour")
            part.write.mode("append").partitionBy("dt", "hour").option("compression", "gzip").text(raw_root)
            warehouse.land(spark, raw_root, ods_path)
        return spark.read.parquet(ods_path).drop("raw_path", "file")

    def archived_files(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Each hour has two files, of which the first is gone from the landing zone when the second comes."""
        ods_path = scratch_dir(spark, "ods")
        lines = raw_lines_from_events(spark, sf_dir).withColumn("late", F.pmod(F.xxhash64("line"), F.lit(2)) == 1)
        for late in (False, True):
            raw_root = scratch_dir(spark, "raw")  # as if the files of the first were moved away
            part = lines.filter(F.col("late") == late).drop("late").hint("rebalance", "dt", "hour")
            part.write.partitionBy("dt", "hour").option("compression", "gzip").text(raw_root)
            warehouse.land(spark, raw_root, ods_path)
        return spark.read.parquet(ods_path).drop("raw_path", "file")

    def closed_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The blocking rule on a day that lacks its keys, and the rows that readers still see: those of before."""
        raw_root, root = scratch_dir(spark, "raw"), scratch_dir(spark, "gated")
        lines = raw_lines_from_events(spark, sf_dir)
        last = lines.agg(F.max("dt")).scalar()
        for bad in (False, True):
            part = lines.filter((F.col("dt") == last) == bad)
            line = F.regexp_replace("line", '"id":[^,]*,"type"', '"id":"","type"') if bad else F.col("line")
            part.select("dt", "hour", line.alias("line")).hint("rebalance", "dt", "hour").write.mode("append").partitionBy(
                "dt", "hour").option("compression", "gzip").text(raw_root)
            try:
                warehouse.build_warehouse(spark, raw_root, root)
            except warehouse.GateClosed as closed:
                rules = spark.createDataFrame(closed.rules)
        rows = {name: versions.read_table(spark, root, layer, name).agg(F.count("*").alias("n")).scalar().alias(f"{name}_rows")
                for layer, name in (("ods", "events"), ("dwd", "event_fact"), ("serving", "summary"))}
        return rules.filter("id = 'R1'").select("id", "value", "passed", *rows.values())

    def stored(layer: str, name: str, *without: str) -> Query:
        """A table of the built warehouse, read back."""
        return lambda spark, sf_dir: versions.read_table(spark, _warehouse(spark, sf_dir), layer, name).drop(*without)

    def meta_row(spark: SparkSession, sf_dir: str) -> DataFrame:
        meta = versions.read_table(spark, _warehouse(spark, sf_dir), "serving", "meta")
        return meta.withColumn("built_today", F.abs(F.date_diff(F.current_timestamp(), "built_at")) <= 1).drop("built_at")

    def quality_file(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The rules from the report that was written as JSON."""
        path = scratch_dir(spark, "quality")
        warehouse.write_quality_report(spark, _warehouse(spark, sf_dir), path)
        return spark.read.json(path).select(F.inline("rules"))

    def views(spark: SparkSession, sf_dir: str) -> DataFrame:
        versions.register_views(spark, _warehouse(spark, sf_dir))
        return tables.list_views(spark)

    def sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Rows by the footers, and whether files and bytes are told, of the landed table."""
        return tables.table_size(spark, _landed(spark, sf_dir)).select(
            "rows", (F.col("files") > 0).alias("has_files"), (F.col("bytes") > F.col("rows")).alias("has_bytes"))

    def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_dir(spark, "sample")
        summary = versions.read_table(spark, _warehouse(spark, sf_dir), "serving", "summary")
        tables.export_sample(summary, path, "date", "events")
        return spark.read.parquet(path)

    def extract_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = scratch_dir(spark, "extract")
        warehouse.write_extract(spark, _warehouse(spark, sf_dir), out, rows=20)
        return spark.read.parquet(tables.table_path(out, "ads", "daily_repo_rank"))

    def statement(spark: SparkSession, sf_dir: str) -> DataFrame:
        versions.register_views(spark, _warehouse(spark, sf_dir))
        return warehouse.run_statement(spark, """
            WITH days AS (SELECT date, sum(event_cnt) AS n FROM ads_daily_event_type GROUP BY date)
            SELECT s.date, d.n, s.events FROM days d JOIN serving_summary s ON s.date = d.date
            WHERE s.events = (SELECT max(events) FROM serving_summary)""")

    def ingest_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
        return warehouse.ingest_volume(spark, _raw_zone(spark, sf_dir), _landed(spark, sf_dir)).select(
            "dt", "damaged_files", "hours", "lines", "bad_lines", "rows")

    def hour_states(spark: SparkSession, sf_dir: str) -> DataFrame:
        return warehouse.hour_states(spark, _raw_zone(spark, sf_dir), _landed(spark, sf_dir))

    def gzip_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
        checked = raw.gzip_integrity(raw.raw_files(spark, _raw_zone(spark, sf_dir)))
        return checked.groupBy("dt").agg(F.count_if(~F.col("ok")).alias("damaged_cnt"),
                                         F.count_distinct("hour").alias("hour_cnt"),
                                         F.sum("line_cnt").alias("line_cnt"))

    def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw_root, ods_path = _raw_zone(spark, sf_dir), scratch_dir(spark, "ods")
        land_stream(spark, raw_root, ods_path, scratch_dir(spark, "landing"), hour_folders=True).awaitTermination()
        return quality.hours_by_day(spark.read.parquet(ods_path))

    def incremental_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
        ods_path, fact_path = _landed(spark, sf_dir), scratch_dir(spark, "fact")
        first = tables.stored_partitions(spark, ods_path, "dt").agg(F.min("dt").alias("dt")).first().dt
        warehouse.build_fact_days(spark, ods_path, fact_path, days=[first])
        warehouse.build_fact_days(spark, ods_path, fact_path)  # the days still missing
        warehouse.build_fact_days(spark, ods_path, fact_path, days=[first])  # once more: replaced, not added
        return spark.read.parquet(fact_path)

    def catalog_status(spark: SparkSession, sf_dir: str) -> DataFrame:
        return versions.register_views(spark, _warehouse(spark, sf_dir))

    def extract_report(spark: SparkSession, sf_dir: str) -> DataFrame:
        return warehouse.write_extract(spark, _warehouse(spark, sf_dir), scratch_dir(spark, "extract"), rows=20)

    def bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = raw_lines_from_events(spark, sf_dir).select(F.lit("events").alias("source"), "line")
        text_lines = [
            spark.read.parquet(f"{sf_dir}/{name}.parquet").select(
                F.lit(name).alias("source"), F.explode(F.split(column, "\n")).alias("line"))
            for name, column in {"documents": "text", "pages": "html", "conversations": "text"}.items()
        ]
        for more in text_lines:
            events = events.unionByName(more)
        return raw.bad_line_report(raw.parse_lines(events), "source")

    return {
        "ods_from_raw": lambda spark, sf_dir: raw.ods_rows(raw.parse_lines(raw_lines_from_events(spark, sf_dir))),
        "bad_line_report": bad_lines,
        "landed_ods": landed_ods,
        "landed_late_files": late_files,
        "landed_archived_files": archived_files,
        "closed_gate": closed_gate,
        **{f"stored_{name}": stored("ads", name) for name in rollups.ADS_TABLES},
        "stored_summary": stored("serving", "summary"),
        "stored_dim_repo": stored("dwd", "dim_repo"),
        "stored_dim_actor": stored("dwd", "dim_actor"),
        "stored_dim_date": stored("dwd", "dim_date"),
        "stored_meta": meta_row,
        "stored_quality_report": quality_file,
        "stored_sample": sample,
        "stored_extract": extract_rows,
        "registered_views": views,
        "guarded_statement": statement,
        "landed_size": sizes,
        "ingest_volume": ingest_volume,
        "hour_states": hour_states,
        "gzip_integrity": gzip_integrity,
        "stream_landing": stream_landing,
        "incremental_fact": incremental_fact,
        "catalog_status": catalog_status,
        "extract_report": extract_report,
    }


def queries() -> dict[str, Query]:
    groups = [_rollup_queries(), _fact_queries(), _report_queries(), _quality_queries(),
              _profile_queries(), _text_queries(), _pipeline_queries()]
    return {name: _in_utc(query) for group in groups for name, query in group.items()}


def _in_utc(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pin_utc(spark)
        return query(spark, sf_dir)

    return run
