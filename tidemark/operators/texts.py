"""Routing of questions and audit of logged statements, as one narrow pass over a table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import fixed
from tidemark.functions.expressions import best_topic, from_query_word, statement_verdict, strip, unfenced


def keyword_route(rows: DataFrame, text: str = "text",
                  topics: Mapping[str, Iterable[str]] = fixed.QUESTION_TOPICS) -> DataFrame:
    """Add the best ``topic`` and its ``score``; both NULL where no word occurs.

    The word list is part of the query, so scoring is a projection: no join, no shuffle.
    """
    best = best_topic(F.col("_lower"), topics)
    return (
        rows.withColumn("_lower", F.lower(text)).withColumn("_best", best)
        .withColumns({"topic": F.col("_best.topic"), "score": F.col("_best.score")})
        .drop("_lower", "_best")
    )


def sql_text_audit(rows: DataFrame, text: str = "text") -> DataFrame:
    """Add the cleaned ``statement``, whether it is ``safe`` to run and the ``reason`` if not.

    One step per intermediate text, so that each is computed once per row.
    """
    query, bare = F.col("_query"), F.col("_bare")
    return (
        rows.withColumn("_bare", unfenced(F.coalesce(text, F.lit(""))))
        .withColumn("_query", from_query_word(bare))
        .withColumn("statement", strip(F.rtrim(strip(F.when(query != "", query).otherwise(bare)), F.lit(";"))))
        .withColumn("_lower", F.lower("statement"))
        .withColumn("reason", statement_verdict(F.col("statement"), F.col("_lower")))
        .withColumn("safe", F.col("reason").isNull())
        .drop("_bare", "_query", "_lower")
    )


def capped_answer(rows: DataFrame, limit: int = fixed.ANSWER_ROWS) -> DataFrame:
    """What an interactive answer shows at most."""
    return rows.limit(limit)
