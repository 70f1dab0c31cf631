"""Independent SQL for every registered query that SQL can express.

Written against the given tables and run by another engine, so nothing here
shares code with the operators. Each statement starts from the definitions it
needs: ``ods`` (landed rows) and ``fact``.
"""

from __future__ import annotations

from tidemark.functions import fixed

_TYPES = ", ".join(f"'{t}'" for t in fixed.EVENT_TYPES)

_ODS = """
keyed AS (
  SELECT event_id AS eid, ts, user_id, event_type AS source_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events
), typed AS (
  SELECT *, CASE WHEN eid % 97 = 0 THEN 'SponsorshipEvent' WHEN eid % 53 = 0 THEN 'CreateEvent'
                 WHEN eid % 59 = 0 THEN 'ReleaseEvent'
                 ELSE CASE source_type WHEN 'click' THEN 'PushEvent' WHEN 'view' THEN 'WatchEvent'
                                       WHEN 'signup' THEN 'ForkEvent' WHEN 'purchase' THEN 'PullRequestEvent'
                                       WHEN 'error' THEN 'IssuesEvent' END END AS event_type
  FROM keyed
), ods AS (
  SELECT eid, CAST(eid AS VARCHAR) AS event_id, event_type, user_id AS actor_id,
         'u' || user_id || CASE user_id % 10 WHEN 3 THEN '[bot]' WHEN 7 THEN '-bot' ELSE '' END AS actor_login,
         k AS repo_id,
         'org' || (k % 10) || '/repo' || k || CASE WHEN eid % 50 = 0 THEN '-renamed' ELSE '' END AS repo_name,
         CASE WHEN k % 4 <> 0 THEN k % 10 END AS org_id,
         CASE WHEN k % 4 <> 0 THEN 'org' || (k % 10) END AS org_login,
         strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS created_at, eid % 11 <> 0 AS is_public,
         CAST(ts AS DATE) AS dt, CAST(hour(ts) AS INTEGER) AS hour,
         date_trunc('second', ts) AS event_ts, k,
         CASE eid % 4 WHEN 0 THEN 'opened' WHEN 1 THEN 'merged' WHEN 2 THEN 'closed' ELSE 'reopened' END AS action,
         CASE WHEN event_type IN ('PushEvent', 'CreateEvent') THEN 'refs/heads/b' || (k % 3) END AS push_ref,
         CASE WHEN event_type IN ('PushEvent', 'CreateEvent')
              THEN CASE eid % 3 WHEN 0 THEN 'branch' WHEN 1 THEN 'tag' ELSE 'repository' END END AS create_ref_type,
         CASE WHEN event_type = 'ForkEvent' AND k % 3 = 0 THEN CASE WHEN k % 2 = 0 THEN 'Go' ELSE 'C' END END AS language,
         CASE WHEN event_type = 'IssuesEvent' THEN CAST(eid % 777 AS INTEGER) END AS issue_number
  FROM typed
)"""

_FACT = _ODS + f""", fact AS (
  SELECT event_id, event_type, actor_id, actor_login, repo_id, repo_name, coalesce(org_login, '') AS org_login,
         event_ts, dt, hour, CAST(k % 7 AS INTEGER) AS push_size, CAST(k % 5 AS INTEGER) AS push_distinct_size,
         push_ref, CAST(eid % 1000 AS INTEGER) AS pr_number, language, issue_number, create_ref_type,
         CASE WHEN event_type = 'PullRequestEvent' THEN action END AS pr_action,
         CASE WHEN event_type IN ('IssuesEvent', 'IssueCommentEvent') THEN action END AS issue_action,
         CASE WHEN event_type = 'ReleaseEvent' THEN action END AS release_action
  FROM ods WHERE event_type IN ({_TYPES}) AND event_id <> ''
)"""


_PAYLOAD = """('{"size":' || (k % 7) || ',"distinct_size":' || (k % 5)
      || coalesce(',"ref":"' || push_ref || '","ref_type":"' || create_ref_type || '"', '')
      || ',"action":"' || action || '","number":' || (eid % 1000)
      || coalesce(',"issue":{"number":' || issue_number || '}', '')
      || coalesce(',"forkee":{"language":"' || language || '"}', '') || '}')"""


def _counts(*names: str) -> str:
    return ", ".join(
        f"CAST(sum(CASE WHEN event_type = '{fixed.COUNT_COLUMNS[n]}' THEN 1 ELSE 0 END) AS BIGINT) AS {n}"
        for n in names)


def _rank(key: str, label: str, distinct: str, name: str, *counts: str) -> str:
    """The rank tables in their join form."""
    picked = "".join(f", p.{c}" for c in counts)
    return f"""
  SELECT b.dt AS date, b.{key}, b.{label}, b.event_cnt, b.{name}{picked}
  FROM (SELECT dt, {key}, {label}, count(*) AS event_cnt, count(DISTINCT {distinct}) AS {name}
        FROM fact GROUP BY ALL) b
  LEFT JOIN (SELECT dt, {key}, {_counts(*counts)} FROM fact GROUP BY ALL) p
    ON b.dt = p.dt AND b.{key} = p.{key}"""


_PIVOT = tuple(fixed.COUNT_COLUMNS)
_ADS = {
    "daily_event_type": "SELECT dt AS date, event_type, count(*) AS event_cnt, count(DISTINCT actor_id) AS actor_cnt "
                        "FROM fact GROUP BY ALL",
    "daily_repo_rank": _rank("repo_id", "repo_name", "actor_id", "actor_cnt", *_PIVOT),
    "daily_actor_active": _rank("actor_id", "actor_login", "repo_id", "repo_cnt", "push_cnt", "pr_cnt", "issue_cnt"),
    "daily_org_rank": "SELECT dt AS date, org_login, count(*) AS event_cnt, count(DISTINCT repo_id) AS repo_cnt, "
                      "count(DISTINCT actor_id) AS actor_cnt FROM fact WHERE org_login <> '' GROUP BY ALL",
    "hourly_activity": "SELECT dt AS date, hour, count(*) AS event_cnt, count(DISTINCT actor_id) AS actor_cnt, "
                       "count(DISTINCT repo_id) AS repo_cnt FROM fact GROUP BY ALL",
    "daily_pr_funnel": """
  SELECT dt AS date, count(*) FILTER (pr_action = 'opened') AS opened_cnt,
         count(*) FILTER (pr_action = 'merged') AS merged_cnt, count(*) FILTER (pr_action = 'closed') AS closed_cnt,
         count(*) FILTER (pr_action = 'reopened') AS reopened_cnt, count(*) AS total_cnt,
         count(DISTINCT repo_id) AS repo_cnt, count(DISTINCT actor_id) AS actor_cnt,
         round(merged_cnt::DOUBLE / nullif(merged_cnt + closed_cnt, 0), 4) AS merge_rate
  FROM fact WHERE event_type = 'PullRequestEvent' GROUP BY dt""",
    "daily_summary": "SELECT dt AS date, count(*) AS events, count(DISTINCT repo_id) AS repos, "
                     "count(DISTINCT actor_id) AS actors FROM fact GROUP BY dt",
}

_RANGE_DISTINCT = ("SELECT count(*) AS events, count(DISTINCT dt) AS days, count(DISTINCT repo_id) AS repos, "
                   "count(DISTINCT actor_id) AS actors FROM fact WHERE {}")

_SPAN = "date IS NOT NULL"
_HUMAN = "actor_login NOT LIKE '%[bot]' AND actor_login NOT LIKE '%-bot'"

_DIM_REPO = """
  SELECT repo_id, count(*) AS event_cnt, min(dt) AS first_seen_dt, max(dt) AS last_seen_dt,
         arg_max(repo_name, {'t': event_ts, 'v': repo_name}) FILTER (repo_name <> '') AS repo_name,
         arg_max(org_login, {'t': event_ts, 'v': org_login}) FILTER (org_login <> '') AS org_login,
         arg_max(language, {'t': event_ts, 'v': language}) FILTER (language IS NOT NULL) AS language
  FROM fact GROUP BY repo_id"""
_DIM_ACTOR = """
  SELECT actor_id, count(*) AS event_cnt, min(dt) AS first_seen_dt, max(dt) AS last_seen_dt,
         arg_max(actor_login, {'t': event_ts, 'v': actor_login}) FILTER (actor_login <> '') AS actor_login
  FROM fact GROUP BY actor_id"""
_DIM_DATE = """
  SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
         CAST(day(d) AS INTEGER) AS day, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
         CAST(dayofweek(d) + 1 AS INTEGER) AS weekday, dayofweek(d) IN (0, 6) AS is_weekend
  FROM (SELECT unnest(generate_series(min(dt)::TIMESTAMP, max(dt)::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM fact)"""


def _with_fact(body: str) -> str:
    return f"WITH {_FACT} {body}"


def _with_ods(body: str) -> str:
    return f"WITH {_ODS} {body}"


def _over(table: str, body: str) -> str:
    """``body`` over one rollup, under the rollup's name."""
    return f"WITH {_FACT}, {table} AS ({_ADS[table]}) {body}"


def _top(table: str, tie: str, rows: int) -> str:
    return _over(table, f"""
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY date ORDER BY event_cnt DESC, {tie}) AS place FROM {table}
  ) WHERE place <= {rows}""")


def _sums(by: str, where: str, tail: str, **measures: str) -> str:
    picked = "".join(f", CAST(sum({c}) AS BIGINT) AS {n}" for n, c in measures.items())
    return f" SELECT {by}{picked} FROM {{t}} {('WHERE ' + where) if where else ''} GROUP BY {by} {tail}"


def _leaders(table: str, by: str, top: int, where: str = _SPAN, **measures: str) -> str:
    tail = f"ORDER BY events DESC, {by} LIMIT {top}"
    return _over(table, _sums(by, where, tail, **measures).format(t=table))


_REPO = {"events": "event_cnt", "stars": "star_cnt", "prs": "pr_cnt"}
_ORG = {"events": "event_cnt", "repos_daysum": "repo_cnt", "actors_daysum": "actor_cnt"}
_ACTOR = {"events": "event_cnt", "repos_daysum": "repo_cnt"}


def _mix(top: int) -> str:
    return _over("daily_event_type", f"""
  , cells AS (SELECT date, event_type, sum(event_cnt) AS n FROM daily_event_type WHERE {_SPAN} GROUP BY ALL),
  biggest AS (SELECT event_type FROM cells GROUP BY event_type ORDER BY sum(n) DESC, event_type LIMIT {top})
  SELECT date, CASE WHEN event_type IN (FROM biggest) THEN event_type ELSE 'other' END AS kind,
         CAST(sum(n) AS BIGINT) AS cnt
  FROM cells GROUP BY ALL""")


_HEAT = f"SELECT date, hour, CAST(sum(event_cnt) AS BIGINT) AS cnt FROM hourly_activity WHERE {_SPAN} GROUP BY ALL"
_SERIES = f"""
  SELECT date, CAST(sum(opened_cnt) AS BIGINT) AS opened, CAST(sum(merged_cnt) AS BIGINT) AS merged,
         CAST(sum(closed_cnt) AS BIGINT) AS closed,
         round(sum(merged_cnt)::DOUBLE / nullif(sum(merged_cnt) + sum(closed_cnt), 0), 4) AS merge_rate
  FROM daily_pr_funnel WHERE {_SPAN} GROUP BY date"""


def _changes(source: str, day: str) -> str:
    return f"""
  daily AS (SELECT {day} AS dt, count(*) AS n FROM {source} GROUP BY ALL),
  steps AS (SELECT dt, n, lag(dt) OVER (ORDER BY dt) AS prev_dt, lag(n) OVER (ORDER BY dt) AS prev_n FROM daily),
  changes AS (SELECT *, abs(n - prev_n)::DOUBLE / prev_n AS change FROM steps)"""


_VOLATILITY = """
  SELECT count(*) AS days, coalesce(max(change), 0.0) AS worst_change,
         (SELECT prev_dt FROM changes WHERE change > 0 ORDER BY change DESC, dt LIMIT 1) AS worst_from,
         (SELECT dt FROM changes WHERE change > 0 ORDER BY change DESC, dt LIMIT 1) AS worst_to,
         coalesce(list_sort(list(change) FILTER (change IS NOT NULL))[count(change) // 2 + 1], 0.0) AS median_change,
         coalesce(max(change), 0.0) < 1.0 OR count(*) < 2 AS passed
  FROM changes"""
_CALIBRATION = """
  SELECT count(change) AS changes, min(change) AS min_change,
         list_sort(list(change) FILTER (change IS NOT NULL))[count(change) // 2 + 1] AS median_change,
         round(avg(change), 9) AS mean_change, round(stddev(change), 9) AS stddev_change, max(change) AS max_change,
         round(avg(change) + 2 * stddev(change), 9) AS suggested_limit
  FROM changes"""


def _hours(source: str, day: str, hour: str) -> str:
    return f"""
  days AS (SELECT {day} AS dt, count(DISTINCT {hour}) AS h FROM {source} GROUP BY 1)
  SELECT count(*) AS days, coalesce(min(h), 0) AS worst_hours, count(*) FILTER (h < 24) AS short_days,
         coalesce(array_to_string(list_sort(list(dt || ' (' || h || 'h)') FILTER (h < 24)), ', '), '')
           AS short_list,
         coalesce(min(h), 0) >= 23 AS passed
  FROM days"""


def _grid(source: str, day: str, hour: str) -> str:
    return f"""
  landed AS (SELECT DISTINCT {day} AS dt, {hour} AS hour FROM {source}),
  grid AS (SELECT unnest(generate_series(min(dt)::TIMESTAMP, max(dt)::TIMESTAMP + INTERVAL 23 HOUR,
                                         INTERVAL 1 HOUR)) AS h FROM landed),
  expected AS (SELECT CAST(h AS DATE) AS dt, CAST(hour(h) AS INTEGER) AS hour FROM grid)"""


def _missing(source: str, day: str, hour: str) -> str:
    return _grid(source, day, hour) + " SELECT dt, hour FROM expected ANTI JOIN landed USING (dt, hour)"


def _blanks(*columns: str) -> str:
    parts = ", ".join(f"count(*) FILTER ({c} IS NULL OR {c} = '') AS {c}_blank" for c in columns)
    return f"SELECT count(*) AS row_cnt, {parts} FROM ods"


def _duplicates(source: str, key: str) -> str:
    return f"""
  SELECT count(*) AS row_cnt, count(DISTINCT {key}) AS unique_cnt, count(*) - count(DISTINCT {key}) AS duplicate_cnt,
         (count(*) - count(DISTINCT {key}))::DOUBLE / greatest(count(*), 1) AS duplicate_rate,
         (count(*) - count(DISTINCT {key}))::DOUBLE / greatest(count(*), 1) < 0.001 AS passed
  FROM {source}"""


_RULES = f"""
, {_changes('fact', 'dt')},
r1 AS ({_blanks('event_id', 'event_type', 'created_at')}),
r2 AS ({_duplicates('fact', 'event_id')}),
r3 AS (WITH {_hours('ods', 'dt', 'hour')}),
r4 AS ({_VOLATILITY}),
rules AS (
  SELECT 'R1' AS id, 'not null' AS name, 'ods.events' AS target,
         CAST(event_id_blank + event_type_blank + created_at_blank AS DOUBLE) AS value, '= 0' AS expect,
         event_id_blank + event_type_blank + created_at_blank = 0 AS passed, 'block' AS action,
         row_cnt || ' rows | blank event_id ' || event_id_blank || ' event_type ' || event_type_blank ||
         ' created_at ' || created_at_blank AS detail FROM r1
  UNION ALL
  SELECT 'R2', 'unique', 'dwd.event_fact', duplicate_rate, '< 0.1%', passed, 'warn',
         duplicate_cnt || ' duplicates | ' || row_cnt || ' rows, ' || unique_cnt || ' distinct' FROM r2
  UNION ALL
  SELECT 'R3', 'complete', 'ods.events', CAST(worst_hours AS DOUBLE), '>= 23', passed, 'warn',
         short_days || '/' || days || ' days short of 24 hours: ' || short_list FROM r3
  UNION ALL
  SELECT 'R4', 'volatility', 'dwd.event_fact', worst_change, '< 100%', passed, 'warn',
         'steepest ' || coalesce(worst_from::VARCHAR, 'none') || ' to ' || coalesce(worst_to::VARCHAR, 'none') ||
         ' | ' || days || ' days' FROM r4
  UNION ALL
  SELECT 'R5', 'enum', 'dwd.event_fact', CAST(count(*) FILTER (event_type NOT IN ({_TYPES})) AS DOUBLE), 'all known',
         count(*) FILTER (event_type NOT IN ({_TYPES})) = 0, 'warn', '15 known types' FROM fact
)"""


def _score(words: list[str]) -> str:
    return " + ".join(f"CASE WHEN contains(t, '{w}') THEN {len(w) + 2} ELSE 0 END" for w in words)


def _route(topics: dict[str, list[str]]) -> str:
    scores = ", ".join(f"{_score(words)} AS s{i}" for i, words in enumerate(topics.values()))
    best = f"greatest({', '.join(f's{i}' for i in range(len(topics)))})"
    cases = " ".join(f"WHEN s{i} = {best} THEN '{name}'" for i, name in enumerate(topics))
    return f"""
  SELECT conv_id, turn, role, CASE WHEN {best} > 0 THEN CASE {cases} END END AS topic,
         CASE WHEN {best} > 0 THEN CAST({best} AS INTEGER) END AS score
  FROM (SELECT conv_id, turn, role, {scores}
        FROM (SELECT *, lower(text) AS t FROM conversations))"""


_EDGE = r"[^\p{L}\p{N}\p{M}\p{Pc}]"
_AUDIT = rf"""
WITH stripped AS (SELECT doc_id, trim(coalesce(text, ''), '{fixed.WHITESPACE}') AS s FROM documents),
opened AS (SELECT doc_id, regexp_replace(s, '(?i)^```(?:sql)?\s*', '') AS s FROM stripped),
bare AS (SELECT doc_id, regexp_replace(s, '\s*```\z', '') AS s FROM opened),
found AS (SELECT doc_id, s, regexp_extract(s, '(?is)(?:^|{_EDGE})((?:select|with)(?:{_EDGE}.*)?)\z', 1) AS q FROM bare),
cleaned AS (
  SELECT doc_id, trim(rtrim(trim(CASE WHEN q <> '' THEN q ELSE s END, '{fixed.WHITESPACE}'), ';'),
                      '{fixed.WHITESPACE}') AS s
  FROM found),
judged AS (
  SELECT doc_id, s, CASE
    WHEN s = '' THEN 'empty'
    WHEN regexp_matches(s, '(?i)(?:^|{_EDGE})(?:{"|".join(fixed.FORBIDDEN_WORDS)})(?:{_EDGE}|\z)') THEN 'forbidden word'
    WHEN NOT regexp_matches(s, '(?i)^\s*(?:select|with)(?:{_EDGE}|\z)') THEN 'not a query' END AS reason
  FROM cleaned)
SELECT doc_id, reason IS NULL AS safe, reason, CAST(length(s) AS INTEGER) AS statement_chars FROM judged"""


_LANDED = f"""
  SELECT event_id, event_type, actor_id, actor_login, repo_id, repo_name, org_id, org_login, created_at, is_public,
         {_PAYLOAD} AS payload, dt, hour FROM ods"""


def oracle_sql() -> dict[str, str]:
    from tidemark.plans.catalog import CONVERSATION_TOPICS

    out = {name: _with_fact(body) for name, body in _ADS.items()}
    out |= {
        "daily_repo_rank_exact": _with_fact(
            f"SELECT dt AS date, repo_id, repo_name, count(*) AS event_cnt, count(DISTINCT actor_id) AS actor_cnt, "
            f"{_counts(*_PIVOT)} FROM fact GROUP BY ALL"),
        "dataset_meta": _over("daily_summary", "SELECT count(*) AS days, min(date) AS date_from, max(date) AS date_to, "
                                               "'full' AS kind FROM daily_summary"),
        "topn_repo_per_day": _top("daily_repo_rank", "repo_id, repo_name", 20),
        "topn_actor_per_day": _top("daily_actor_active", "actor_id, actor_login", 20),
        "topn_org_per_day": _top("daily_org_rank", "org_login", 3),
        "orders_daily_funnel": """
  SELECT CAST(o_orderdate AS DATE) AS date, count(*) FILTER (o_orderstatus = 'O') AS opened_cnt,
         count(*) FILTER (o_orderstatus = 'F') AS merged_cnt, count(*) FILTER (o_orderstatus = 'P') AS closed_cnt,
         CAST(0 AS BIGINT) AS reopened_cnt, count(*) AS total_cnt, count(DISTINCT o_custkey) AS customer_cnt,
         round(merged_cnt::DOUBLE / nullif(merged_cnt + closed_cnt, 0), 4) AS merge_rate
  FROM orders GROUP BY 1""",
        "topn_part_per_day": """
  SELECT date, part_id, event_cnt FROM (
    SELECT *, row_number() OVER (PARTITION BY date ORDER BY event_cnt DESC, part_id) AS place
    FROM (SELECT CAST(l_shipdate AS DATE) AS date, l_partkey AS part_id, count(*) AS event_cnt
          FROM lineitem GROUP BY ALL))
  WHERE place <= 3""",
        # fact and dimensions
        "fact_payload_parsed": _with_ods("""
  SELECT event_id, event_type, actor_id, actor_login, repo_id, repo_name, coalesce(org_login, '') AS org_login,
         event_ts, dt, CAST(k % 7 AS INTEGER) AS push_size, CAST(k % 5 AS INTEGER) AS push_distinct_size, push_ref,
         action, CAST(eid % 1000 AS INTEGER) AS pr_number, language, issue_number, create_ref_type FROM ods"""),
        "fact_whitelisted": _with_fact("SELECT * EXCLUDE (hour) FROM fact"),
        "fact_action_columns": _with_fact(
            "SELECT event_id, event_type, pr_action, issue_action, release_action FROM fact"),
        "payload_language": _with_fact("SELECT event_type, language, count(*) AS event_cnt FROM fact GROUP BY ALL"),
        "dim_repo": _with_fact(_DIM_REPO),
        "dim_actor": _with_fact(_DIM_ACTOR),
        "dim_date": _with_fact(_DIM_DATE),
        "fact_enriched": _with_fact(f""", r AS ({_DIM_REPO}), a AS ({_DIM_ACTOR}), d AS ({_DIM_DATE})
  SELECT f.event_id, f.event_type, f.dt, f.repo_id, r.repo_name AS repo_name_now, r.org_login AS org_login_now,
         r.language AS repo_language, f.actor_id, a.actor_login AS actor_login_now,
         d.week_of_year, d.weekday, d.is_weekend
  FROM fact f LEFT JOIN r ON f.repo_id = r.repo_id LEFT JOIN a ON f.actor_id = a.actor_id
  LEFT JOIN d ON f.dt = d.date"""),
        # dashboard
        "range_distinct": _with_fact(_RANGE_DISTINCT.format("true")),
        "range_distinct_week": _with_fact(_RANGE_DISTINCT.format("dt BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'")),
        "last_full_days": _over("daily_event_type", "SELECT * FROM daily_event_type "
                                "WHERE date BETWEEN DATE '2024-01-13' AND DATE '2024-01-19'"),
        "available_dates": _with_fact("SELECT DISTINCT dt AS date FROM fact"),
        "kpi_range": _over("daily_summary", f"""
  SELECT CAST(sum(events) AS BIGINT) AS events, count(*) AS days, avg(repos) AS repos_daily, avg(actors) AS actors_daily
  FROM daily_summary WHERE {_SPAN}"""),
        "event_mix_top7": _mix(7),
        "event_mix_top3": _mix(3),
        "repo_leaderboard": _leaders("daily_repo_rank", "repo_name", 15, **_REPO),
        "contributor_leaderboard": _leaders("daily_actor_active", "actor_login", 15, f"{_SPAN} AND {_HUMAN}", **_ACTOR),
        "contributor_leaderboard_all": _leaders("daily_actor_active", "actor_login", 15, **_ACTOR),
        "org_leaderboard": _leaders("daily_org_rank", "org_login", 15, **_ORG),
        "hour_heatmap": _over("hourly_activity", _HEAT),
        "hour_heatmap_wide": _over("hourly_activity", "SELECT date, " + ", ".join(
            f"CAST(coalesce(sum(event_cnt) FILTER (hour = {h}), 0) AS BIGINT) AS h{h:02d}" for h in range(24)
        ) + f" FROM hourly_activity WHERE {_SPAN} GROUP BY date"),
        "peak_trough": _over("hourly_activity", f""", heat AS ({_HEAT}),
  peak AS (FROM heat ORDER BY cnt DESC, date, hour LIMIT 1), low AS (FROM heat ORDER BY cnt, date, hour LIMIT 1)
  SELECT peak.date AS peak_date, peak.hour AS peak_hour, peak.cnt AS peak_cnt, low.date AS low_date,
         low.hour AS low_hour, low.cnt AS low_cnt, peak.cnt::DOUBLE / greatest(low.cnt, 1) AS peak_ratio
  FROM peak, low"""),
        "funnel_series": _over("daily_pr_funnel", _SERIES),
        "funnel_long": _over("daily_pr_funnel", f""", series AS ({_SERIES})
  SELECT date, 'opened' AS action, opened AS n FROM series UNION ALL SELECT date, 'merged', merged FROM series
  UNION ALL SELECT date, 'closed', closed FROM series"""),
        "capped_answer": _over("daily_repo_rank", "SELECT * FROM daily_repo_rank "
                               "ORDER BY date, event_cnt DESC, repo_id, repo_name LIMIT 200"),
        # questions
        "bot_share": _over("daily_actor_active", f"""
  SELECT CASE WHEN actor_login LIKE '%[bot]' OR actor_login LIKE '%-bot' THEN 'bot' ELSE 'human' END AS kind,
         CAST(sum(event_cnt) AS BIGINT) AS events,
         round(sum(event_cnt)::DOUBLE * 100 / (SELECT sum(event_cnt) FROM daily_actor_active), 2) AS pct
  FROM daily_actor_active GROUP BY 1"""),
        "daily_merge_rate": _over("daily_pr_funnel", """
  SELECT date, opened_cnt, merged_cnt, closed_cnt,
         round(merged_cnt::DOUBLE / nullif(merged_cnt + closed_cnt, 0), 4) AS merge_rate FROM daily_pr_funnel"""),
        "top10_repos": _leaders("daily_repo_rank", "repo_name", 10, "", **_REPO),
        "events_by_hour": _over("hourly_activity", _sums("hour", "", "", events="event_cnt").format(t="hourly_activity")),
        "top10_orgs": _leaders("daily_org_rank", "org_login", 10, "", **_ORG),
        "event_type_totals": _over("daily_event_type", _sums(
            "event_type", "", "", events="event_cnt").format(t="daily_event_type")),
        "scale_overview": _with_fact("SELECT count(*) AS events, count(DISTINCT repo_id) AS repos, "
                                     "count(DISTINCT actor_id) AS actors, count(DISTINCT dt) AS days FROM fact"),
        "top10_contributors": _leaders("daily_actor_active", "actor_login", 10, _HUMAN, **_ACTOR),
        # quality
        "dq_not_null": _with_ods(_blanks("event_id", "event_type", "created_at")),
        "dq_unique": _with_fact(_duplicates("fact", "event_id")),
        "dq_hour_complete": f"WITH {_ODS}, {_hours('ods', 'dt', 'hour')}",
        "dq_volatility": f"WITH {_FACT}, {_changes('fact', 'dt')} {_VOLATILITY}",
        "dq_enum": _with_ods(f"""
  SELECT count(*) FILTER (event_type NOT IN ({_TYPES})) AS unknown_cnt,
         count(*) FILTER (event_type NOT IN ({_TYPES})) = 0 AS passed FROM ods"""),
        "dq_report": f"WITH {_FACT} {_RULES} SELECT * FROM rules",
        "dq_summary": f"""WITH {_FACT} {_RULES}
  SELECT 'all' AS scope, count(*) AS total, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed,
         count(*) FILTER (NOT passed AND action = 'block') AS blocking_failed,
         count(*) FILTER (NOT passed AND action = 'block') = 0 AS gate_open FROM rules""",
        "volatility_calibration": f"WITH {_FACT}, {_changes('fact', 'dt')} {_CALIBRATION}",
        "volume_spread": _with_fact(""", d AS (SELECT count(*) AS n FROM fact GROUP BY dt)
  SELECT count(*) AS days, min(n) AS min_rows, max(n) AS max_rows, max(n)::DOUBLE / min(n) AS spread FROM d"""),
        "column_coverage": _with_fact("""
  SELECT count(*) AS row_cnt, count(language) AS filled_cnt, count(language)::DOUBLE / greatest(count(*), 1) AS coverage
  FROM fact"""),
        "filter_drop": _with_ods(f""", c AS (
    SELECT count(*) AS row_cnt, count(*) FILTER (event_type IN ({_TYPES}) AND event_id <> '') AS kept_cnt FROM ods)
  SELECT row_cnt, kept_cnt, row_cnt - kept_cnt AS dropped_cnt,
         (row_cnt - kept_cnt) * 100::DOUBLE / greatest(row_cnt, 1) AS dropped_pct FROM c"""),
        "missing_hours": f"WITH {_ODS}, {_missing('ods', 'dt', 'hour')}",
        "orders_missing_hours":
            f"WITH {_missing('orders', 'CAST(o_orderdate AS DATE)', 'CAST(hour(o_orderdate) AS INTEGER)')}",
        "lineitem_duplicates": _duplicates("lineitem", "(l_orderkey, l_linenumber)"),
        "lineitem_volatility": f"WITH {_changes('lineitem', 'CAST(l_shipdate AS DATE)')} {_VOLATILITY}",
        "lineitem_calibration": f"WITH {_changes('lineitem', 'CAST(l_shipdate AS DATE)')} {_CALIBRATION}",
        "orders_hour_complete": f"WITH {_hours('orders', 'CAST(o_orderdate AS DATE)', 'hour(o_orderdate)')}",
        # acceptance report
        "ods_profile": _with_ods("""
  SELECT count(*) AS row_cnt, count(DISTINCT event_id) AS event_cnt, count(DISTINCT repo_name) AS repo_cnt,
         count(DISTINCT actor_login) AS actor_cnt, count(DISTINCT dt) AS day_cnt,
         min(created_at) AS first_at, max(created_at) AS last_at,
         round(count(DISTINCT event_id)::DOUBLE * 100 / count(*), 2) AS unique_pct FROM ods"""),
        "ods_null_audit": _with_ods(_blanks("event_id", "event_type", "repo_name", "created_at")),
        "ods_duplicates": _with_ods(_duplicates("ods", "event_id")),
        "ods_hour_coverage": _with_ods("""
  SELECT count(DISTINCT (dt, hour)) AS hour_cnt, count(DISTINCT dt) AS day_cnt, count(DISTINCT dt) * 24 AS expected_cnt,
         count(DISTINCT (dt, hour)) >= count(DISTINCT dt) * 23 AS passed FROM ods"""),
        "ods_by_day": _with_ods("SELECT dt, count(DISTINCT hour) AS hour_cnt, count(*) AS row_cnt FROM ods GROUP BY dt"),
        "ods_type_share": _with_ods("""
  SELECT event_type, count(*) AS n, round(count(*)::DOUBLE * 100 / (SELECT count(*) FROM ods), 1) AS pct
  FROM ods GROUP BY event_type ORDER BY n DESC, event_type LIMIT 10"""),
        "ods_top_repos": _with_ods(
            "SELECT repo_name, count(*) AS n FROM ods GROUP BY repo_name ORDER BY n DESC, repo_name LIMIT 10"),
        "ods_payload_length": _with_ods(f"SELECT avg(length({_PAYLOAD})) AS mean_length FROM ods"),
        "document_text_length": "SELECT avg(length(text)) AS mean_length FROM documents",
        # texts
        "keyword_route": _route(CONVERSATION_TOPICS),
        "sql_text_audit": _AUDIT,
        # through files
        "ods_from_raw": _with_ods(_LANDED),
        "landed_ods": _with_ods(_LANDED),
        "landed_late_files": _with_ods(_LANDED),
        "landed_archived_files": _with_ods(_LANDED),
        "closed_gate": _with_fact(""", d AS (SELECT max(dt) AS last FROM ods)
  SELECT 'R1' AS id, CAST((SELECT count(*) FROM ods, d WHERE dt = last) AS DOUBLE) AS value, false AS passed,
         (SELECT count(*) FROM ods, d WHERE dt < last) AS events_rows, (SELECT count(*) FROM fact, d WHERE dt < last) AS event_fact_rows,
         (SELECT count(DISTINCT dt) FROM fact, d WHERE dt < last) AS summary_rows"""),
        **{f"stored_{name}": _with_fact(body) for name, body in _ADS.items() if name != "daily_summary"},
        "stored_summary": _with_fact(_ADS["daily_summary"]),
        "stored_dim_repo": _with_fact(_DIM_REPO),
        "stored_dim_actor": _with_fact(_DIM_ACTOR),
        "stored_dim_date": _with_fact(_DIM_DATE),
        "stored_meta": _with_fact("SELECT count(DISTINCT dt) AS days, min(dt) AS date_from, max(dt) AS date_to, "
                                  "'full' AS kind, true AS built_today FROM fact"),
        "stored_quality_report": f"WITH {_FACT} {_RULES} SELECT * FROM rules",
        "stored_sample": _with_fact("SELECT dt AS date, count(*) AS events FROM fact GROUP BY dt"),
        "stored_extract": _top("daily_repo_rank", "repo_id, repo_name", 20),
        "registered_views": "SELECT unnest(['ods', 'dwd', 'dwd', 'dwd', 'dwd', 'ads', 'ads', 'ads', 'ads', 'ads', 'ads', 'serving', 'serving']) "
                            "AS layer, unnest(['events', 'event_fact', 'dim_repo', 'dim_actor', 'dim_date', 'daily_event_type', "
                            "'daily_repo_rank', 'daily_actor_active', 'daily_org_rank', 'hourly_activity', 'daily_pr_funnel', "
                            "'summary', 'meta']) AS \"table\"",
        "guarded_statement": _with_fact(""", d AS (SELECT dt, count(*) AS n FROM fact GROUP BY dt)
  SELECT dt AS date, n, n AS events FROM d WHERE n = (SELECT max(n) FROM d)"""),
        "landed_size": _with_ods("SELECT count(*) AS rows, true AS has_files, true AS has_bytes FROM ods"),
        "bad_line_report": """
WITH lines AS (
  SELECT 'documents' AS source, unnest(string_split(text, chr(10))) AS line FROM documents
  UNION ALL SELECT 'pages', unnest(string_split(html, chr(10))) FROM pages
  UNION ALL SELECT 'conversations', unnest(string_split(text, chr(10))) FROM conversations)
SELECT source, count(*) AS line_cnt,
       count(*) FILTER (NOT json_valid(line) OR json_type(CASE WHEN json_valid(line) THEN line END) <> 'OBJECT')
         AS bad_cnt
FROM lines GROUP BY source
UNION ALL SELECT 'events', count(*), 0 FROM events""",
        "ingest_volume": _with_ods(
            "SELECT dt, CAST(0 AS BIGINT) AS damaged_files, CAST(count(DISTINCT (dt, hour)) AS BIGINT) AS hours, "
            "count(*) AS lines, CAST(0 AS BIGINT) AS bad_lines, count(*) AS rows FROM ods GROUP BY ROLLUP (dt)"),
        "hour_states": f"""WITH {_ODS}, {_grid('ods', 'dt', 'hour')}
  SELECT e.dt, e.hour, CASE WHEN l.dt IS NULL THEN 'missing' ELSE 'landed' END AS state
  FROM expected e LEFT JOIN landed l ON e.dt = l.dt AND e.hour = l.hour""",
        "gzip_integrity": _with_ods("SELECT dt, CAST(0 AS BIGINT) AS damaged_cnt, count(DISTINCT hour) AS hour_cnt, "
                                    "count(*) AS line_cnt FROM ods GROUP BY dt"),
        "stream_landing": _with_ods(
            "SELECT dt, count(DISTINCT hour) AS hour_cnt, count(*) AS row_cnt FROM ods GROUP BY dt"),
        "incremental_fact": _with_fact("SELECT * EXCLUDE (hour) FROM fact"),
        "catalog_status": f"WITH {_FACT} SELECT *, 'ready' AS status FROM (" + " UNION ALL ".join(
            f"SELECT '{layer}' AS layer, '{name}' AS \"table\", count(*) AS rows FROM ({body})"
            for layer, name, body in [
                ("ods", "events", "SELECT * FROM ods"), ("dwd", "event_fact", "SELECT * FROM fact"),
                ("dwd", "dim_repo", _DIM_REPO), ("dwd", "dim_actor", _DIM_ACTOR), ("dwd", "dim_date", _DIM_DATE),
                *[("ads", name, _ADS[name]) for name in _ADS if name != "daily_summary"],
                ("serving", "summary", _ADS["daily_summary"]), ("serving", "meta", "SELECT 1")]) + ")",
        "extract_report": f"WITH {_FACT} SELECT *, round(rows * 100::DOUBLE / greatest(full_rows, 1), 1) AS pct FROM ("
                          + " UNION ALL ".join(
            f"SELECT '{name}' AS \"table\", CAST(sum({'least(n, 20)' if 'rank' in name or 'active' in name else 'n'}) "
            f"AS BIGINT) AS rows, CAST(sum(n) AS BIGINT) AS full_rows "
            f"FROM (SELECT date, count(*) AS n FROM ({_ADS[name]}) GROUP BY date)"
            for name in _ADS if name != "daily_summary") + ")",
    }
    return out
