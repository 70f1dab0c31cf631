"""Names, patterns and thresholds that define the results."""

from __future__ import annotations

# Event kinds kept in the fact table.
EVENT_TYPES = [
    "PushEvent", "PullRequestEvent", "PullRequestReviewEvent",
    "PullRequestReviewCommentEvent", "IssuesEvent", "IssueCommentEvent",
    "WatchEvent", "ForkEvent", "CreateEvent", "DeleteEvent",
    "ReleaseEvent", "CommitCommentEvent", "PublicEvent",
    "MemberEvent", "GollumEvent",
]

# Event kinds with a count column of their own.
COUNT_COLUMNS = {
    "push_cnt": "PushEvent",
    "star_cnt": "WatchEvent",
    "fork_cnt": "ForkEvent",
    "pr_cnt": "PullRequestEvent",
    "issue_cnt": "IssuesEvent",
}

# Pull-request actions of the funnel.
FUNNEL_ACTIONS = ["opened", "merged", "closed", "reopened"]

# Endings that mark a login as automated.
BOT_PATTERNS = ["%[bot]", "%-bot"]

# Words that make a logged statement unsafe.
FORBIDDEN_WORDS = [
    "insert", "update", "delete", "drop", "create", "alter", "truncate", "attach",
    "detach", "copy", "export", "install", "load", "pragma", "call", "set",
]

# Canned questions and the phrases that select them, in order.
QUESTION_TOPICS = {
    "bot_share": ["机器人", "bot", "水军"],
    "daily_merge_rate": ["合并率", "pr 合并", "pr合并", "merge"],
    "top10_repos": ["仓库排行", "仓库榜", "top 仓库", "最活跃的仓库", "最忙的仓库", "仓库活跃"],
    "events_by_hour": ["小时", "时段", "什么时候", "热力", "几点"],
    "top10_orgs": ["组织", "公司", "机构"],
    "event_type_totals": ["事件类型", "类型分布", "push", "pull request 多少"],
    "scale_overview": ["多少条", "总量", "总数", "数据量", "规模"],
    "top10_contributors": ["用户", "贡献者", "谁最活跃", "开发者"],
}

# Thresholds of the quality rules and reports.
MAX_DUPLICATE_RATE = 0.001
MIN_HOURS_PER_DAY = 23
HOURS_PER_DAY = 24
MAX_DAILY_CHANGE = 1.00
ANSWER_ROWS = 200
LEADERBOARD_ROWS = 15
EXTRACT_ROWS_PER_DAY = 300

# Logarithm of a distinct-count sketch's registers: a standard error of 1.04 / sqrt(2 ** 14), 0.8 %.
SKETCH_SIZE = 14

# Fixed value: characters stripped from both ends of a statement.
WHITESPACE = " \t\n\r\f\v\x1c\x1d\x1e\x1f\x85\u00a0\u2028\u2029\u3000"
