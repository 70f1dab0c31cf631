"""The given ``events`` table in the shape of the event log.

``events`` has ids, a time, a user, a kind and ``props = {"k": n}``. The terms
with ``%`` below only give every row a kind, a name or an action; no row is
left out. Repository ``k`` belongs to organisation ``k % 10``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions import fixed

# Kind of the source table -> kind of the event log.
KIND_OF = {
    "click": "PushEvent", "view": "WatchEvent", "signup": "ForkEvent",
    "purchase": "PullRequestEvent", "error": "IssuesEvent",
}


def _k() -> Column:
    return F.col("k")


def _id() -> Column:
    return F.col("event_id")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    )


def _kind() -> Column:
    plain = F.element_at(F.create_map(*[F.lit(x) for pair in KIND_OF.items() for x in pair]), F.col("event_type"))
    return (
        F.when(_id() % 97 == 0, "SponsorshipEvent")
        .when(_id() % 53 == 0, "CreateEvent")
        .when(_id() % 59 == 0, "ReleaseEvent")
        .otherwise(plain)
    )


def _login() -> Column:
    suffix = F.when(F.col("user_id") % 10 == 3, "[bot]").when(F.col("user_id") % 10 == 7, "-bot").otherwise("")
    return F.concat(F.lit("u"), F.col("user_id"), suffix)


def _repo_name() -> Column:
    return F.concat(F.lit("org"), _k() % 10, F.lit("/repo"), _k(), F.when(_id() % 50 == 0, "-renamed").otherwise(""))


def _org() -> Column:
    return F.when(_k() % 4 != 0, F.concat(F.lit("org"), _k() % 10))


def _action() -> Column:
    return F.element_at(F.array(*map(F.lit, ["opened", "merged", "closed", "reopened"])), (_id() % 4 + 1).cast("int"))


def _ref_type() -> Column:
    return F.element_at(F.array(*map(F.lit, ["branch", "tag", "repository"])), (_id() % 3 + 1).cast("int"))


def ods_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed table: envelope columns, payload text, ``dt`` and ``hour``."""
    kind = F.col("kind")
    with_ref = kind.isin("PushEvent", "CreateEvent")
    payload = F.to_json(F.struct(
        (_k() % 7).alias("size"),
        (_k() % 5).alias("distinct_size"),
        F.when(with_ref, F.concat(F.lit("refs/heads/b"), _k() % 3)).alias("ref"),
        F.when(with_ref, _ref_type()).alias("ref_type"),
        _action().alias("action"),
        (_id() % 1000).alias("number"),
        F.when(kind == "IssuesEvent", F.struct((_id() % 777).alias("number"))).alias("issue"),
        F.when((kind == "ForkEvent") & (_k() % 3 == 0),
               F.struct(F.when(_k() % 2 == 0, "Go").otherwise("C").alias("language"))).alias("forkee"),
    ))
    return _events(spark, sf_dir).withColumn("kind", _kind()).select(
        _id().cast("string").alias("event_id"),
        kind.alias("event_type"),
        F.col("user_id").alias("actor_id"),
        _login().alias("actor_login"),
        _k().alias("repo_id"),
        _repo_name().alias("repo_name"),
        F.when(_k() % 4 != 0, _k() % 10).alias("org_id"),
        _org().alias("org_login"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        (_id() % 11 != 0).alias("is_public"),
        payload.alias("payload"),
        F.to_date("ts").alias("dt"),
        F.hour("ts").alias("hour"),
    )


def raw_lines_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(dt, hour, line)``: each event as one raw JSON line."""
    envelope = F.to_json(F.struct(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("type"),
        F.struct(F.col("actor_id").alias("id"), F.col("actor_login").alias("login")).alias("actor"),
        F.struct(F.col("repo_id").alias("id"), F.col("repo_name").alias("name")).alias("repo"),
        F.when(F.col("org_id").isNotNull(),
               F.struct(F.col("org_id").alias("id"), F.col("org_login").alias("login"))).alias("org"),
        F.col("is_public").alias("public"),
        "created_at",
    ))
    opened = F.left(envelope, F.length(envelope) - 1)
    line = F.concat(opened, F.lit(',"payload":'), "payload", F.lit("}"))
    return ods_from_events(spark, sf_dir).select("dt", "hour", line.alias("line"))


def fact_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact columns the rollups read, straight from the table.

    Equals ``build_fact(parse_payload(ods_from_events(...)))`` on these columns
    and saves building and parsing payload text when no payload field is needed
    other than the action.
    """
    return (
        _events(spark, sf_dir)
        .withColumn("kind", _kind())
        .filter(F.col("kind").isin(fixed.EVENT_TYPES))
        .select(
            _id().cast("string").alias("event_id"),
            F.col("kind").alias("event_type"),
            F.col("user_id").alias("actor_id"),
            _login().alias("actor_login"),
            _k().alias("repo_id"),
            _repo_name().alias("repo_name"),
            F.coalesce(_org(), F.lit("")).alias("org_login"),
            F.date_trunc("second", F.col("ts").cast("timestamp")).alias("event_ts"),
            F.to_date("ts").alias("dt"),
            F.when(F.col("kind") == "PullRequestEvent", _action()).alias("pr_action"),
        )
    )
