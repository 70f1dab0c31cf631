"""Declared schemas of the raw envelope, the landed table and the payload."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_STR, _LONG, _INT, _BOOL = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()
_ACCOUNT = _struct(id=_LONG, login=_STR)
_WITH_LANGUAGE = _struct(language=_STR)

#: One raw line. ``payload`` stays text: only its JSON is normalised.
ENVELOPE = _struct(
    id=_STR, type=_STR, actor=_ACCOUNT, repo=_struct(id=_LONG, name=_STR), org=_ACCOUNT,
    payload=_STR, public=_BOOL, created_at=_STR,
)

#: The landed table, without its partition columns ``dt`` and ``hour``.
ODS = _struct(
    event_id=_STR, event_type=_STR, actor_id=_LONG, actor_login=_STR, repo_id=_LONG,
    repo_name=_STR, org_id=_LONG, org_login=_STR, created_at=_STR, is_public=_BOOL, payload=_STR,
)

#: Payload paths in use; kinds differ, so a path that is absent reads as NULL.
PAYLOAD = _struct(
    size=_INT, distinct_size=_INT, ref=_STR, ref_type=_STR, action=_STR, number=_INT,
    pull_request=_struct(base=_struct(repo=_WITH_LANGUAGE)),
    issue=_struct(number=_INT), forkee=_WITH_LANGUAGE, repository=_WITH_LANGUAGE,
)
