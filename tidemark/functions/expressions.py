"""Column expressions shared by the operators; all of them stay inside codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, functions as F

from tidemark.functions import fixed

def is_blank(name: str) -> Column:
    return F.col(name).isNull() | (F.col(name) == "")


def count_where(condition: Column, weight: Column | None = None) -> Column:
    """Number of rows meeting the condition, or their weights' sum; 0, not NULL, for no rows."""
    return F.count_if(condition) if weight is None else F.coalesce(F.sum(F.when(condition, weight)), F.lit(0)).cast("long")


def type_counts(names: Iterable[str] = tuple(fixed.COUNT_COLUMNS), kind: str = "event_type",
                weight: Column | None = None) -> list[Column]:
    """One conditional count per requested column, for use inside ``agg``."""
    return [count_where(F.col(kind) == fixed.COUNT_COLUMNS[n], weight).alias(n) for n in names]


def is_bot(login: str = "actor_login") -> Column:
    """NULL for a NULL login, so neither this nor its negation keeps such a row."""
    return reduce(or_, [F.col(login).like(p) for p in fixed.BOT_PATTERNS])


def ratio(part: Column, whole: Column, digits: int = 4) -> Column:
    """Rounded quotient, NULL where the denominator is zero."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), digits)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part.cast("double") * 100, whole.cast("double")), digits)


def newest(value: str, at: str, keep: Column) -> Column:
    """Value at the largest ``at`` among kept rows; equal times go to the larger value."""
    return F.max(F.when(keep & F.col(at).isNotNull(), F.struct(F.col(at), F.col(value))))[value]


def keyword_score(text: Column, words: Iterable[str]) -> Column:
    """Length of every contained word plus two, summed; ``text`` is lower case already."""
    return reduce(add, [
        F.when(F.contains(text, F.lit(w.lower())), len(w) + 2).otherwise(0) for w in words
    ])


def best_topic(text: Column, topics: Mapping[str, Iterable[str]]) -> Column:
    """Struct ``(score, topic)`` of the best scoring topic; the earlier one wins a tie.

    Both fields are NULL where no word occurs.
    """
    ranked = F.greatest(*[
        F.struct(keyword_score(text, words).alias("score"), F.lit(-i).alias("place"),
                 F.lit(topic).alias("topic"))
        for i, (topic, words) in enumerate(topics.items())
    ])
    return F.when(ranked["score"] > 0, F.struct(ranked["score"].alias("score"), ranked["topic"].alias("topic")))


def unfenced(text: Column) -> Column:
    """Text without surrounding space and code fence."""
    bare = strip(text)
    bare = F.when(F.startswith(bare, F.lit("```")), F.regexp_replace(bare, r"(?iU)^```(?:sql)?\s*", "")).otherwise(bare)
    return F.when(F.endswith(bare, F.lit("```")), F.regexp_replace(bare, r"(?U)\s*```\z", "")).otherwise(bare)


def from_query_word(text: Column) -> Column:
    """Text from its first SELECT or WITH on, '' where there is none."""
    return F.regexp_extract(text, r"(?isU)\b(?:select|with)\b.*\z", 0)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(fixed.WHITESPACE))


def statement_verdict(sql: Column, lower: Column) -> Column:
    """Reason a statement is refused, NULL for a read-only one. Words count anywhere, even quoted.

    ``lower`` is the statement in lower case: plain searches in it spare most
    texts the pattern. The long s is the one letter that matches ``s`` in the
    pattern without becoming it in lower case.
    """
    words = "|".join(fixed.FORBIDDEN_WORDS)
    maybe = reduce(or_, [F.contains(lower, F.lit(w)) for w in [*fixed.FORBIDDEN_WORDS, "\u017f"]])
    return (
        F.when(sql == "", "empty")
        .when(maybe & sql.rlike(rf"(?iU)\b(?:{words})\b"), "forbidden word")
        .when(~sql.rlike(r"(?iU)^\s*(?:select|with)\b"), "not a query")
    )
