"""Secret scans: single matches, and weak candidates linked by what stands near them.

One pass over the texts finds all parts. Parts that prove nothing alone (a user name, a
long random token, an address) are reported only where complementary parts stand in
their scope, the interval of text between two blank lines. Scopes and parts of a text are
both in order, so their interval join is one merge, which keeps the roles of a scope and
forms no pairs; a text's parts never leave its row.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import carried, schema_with, text_slices, unused

# The base patterns, the shortest match of each, and the order of kinds.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX = r"AKIA[A-Z0-9]+", r"[0-9a-f]+"
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24
BASE_KINDS = ("assign", "access", "hex")

#: Weak kinds, in their order after the base kinds.
WEAK_KINDS = ("user", "blob", "endpoint")
KINDS = BASE_KINDS + WEAK_KINDS

USER = r"""(?:user_?name|user|login|account|client_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@+-]{3,})"""
BLOB = r"[A-Za-z0-9+/_-]{32,}"
ENDPOINT = r"""[a-z][a-z0-9+.-]*://[^\x20\x09-\x0D"'<>]{4,}"""

_BLANK_LINE = re.compile(r"\n[ \t\r]*\n")
_CASELESS = re.ASCII | re.IGNORECASE
_ASSIGN, _USER = re.compile(ASSIGN, _CASELESS), re.compile(USER, _CASELESS)
_ACCESS, _BLOB, _ENDPOINT = re.compile(ACCESS), re.compile(BLOB), re.compile(ENDPOINT)
# A run of 24 or more: what the base pattern matches and does not drop.
_HEX = re.compile(f"[0-9a-f]{{{HEX_LENGTH},}}")
_ASSIGN_WORDS, _USER_WORDS = ("passw", "secret", "token", "api"), ("user", "login", "account", "client")

#: What each kind is in a credential, and what a weak kind needs in its scope: a user a secret, a blob an identifier,
#: an endpoint both.
_ROLE = ("secret", "id", "secret", "id", "secret", "endpoint")
_NEEDS = {3: {"secret"}, 4: {"id"}, 5: {"id", "secret"}}

_PART = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
_PARTS = "array<struct<start: int, kind: int, end: int>>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches, kinds by number."""
    low = text.lower()
    out = []
    if any(w in low for w in _ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def _mixed(token: str) -> bool:
    return not token.islower() and not token.isupper() and any(c.isdigit() for c in token)


def weak_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of weak candidates that touch no base span."""
    low = text.lower()
    found = []
    if any(w in low for w in _USER_WORDS):
        found += [(m.start(), 3, m.end()) for m in _USER.finditer(text)]
    found += [(m.start(), 4, m.end()) for m in _BLOB.finditer(text) if _mixed(m[0])]
    if "://" in text:
        found += [(m.start(), 5, m.end()) for m in _ENDPOINT.finditer(text)]
    if not found or not base:
        return sorted(found)
    starts, ends, most = [b[0] for b in base], [], 0
    for b in base:
        most = max(most, b[2])
        ends.append(most)  # of this base span and all before it

    def free(span: tuple[int, int, int]) -> bool:
        before = bisect_right(starts, span[2] - 1)
        return before == 0 or ends[before - 1] <= span[0]

    return sorted(s for s in found if free(s))


def linked(text: str, base: list[tuple[int, int, int]], weak: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The weak spans whose complements stand in their scope; a span belongs to the scope that it begins in."""
    if not weak:
        return []
    out, at, spans = [], 0, sorted(base + weak)
    for end in [*(m.start() for m in _BLANK_LINE.finditer(text)), len(text) + 1]:
        begin = at
        while at < len(spans) and spans[at][0] < end:
            at += 1
        roles = {_ROLE[kind] for _, kind, _ in spans[begin:at]}
        out += [s for s in spans[begin:at] if s[1] in _NEEDS and _NEEDS[s[1]] <= roles]
    return out


def _parts(text: str) -> tuple[list[dict], list[dict]]:
    base = base_spans(text)
    return tuple([{"start": s, "kind": k, "end": e} for s, k, e in spans] for spans in (base, linked(text, base, weak_spans(text, base))))


def _spans(parts_col: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    one = lambda p: F.concat_ws(":", F.element_at(names, p["kind"] + 1), p["start"], p["end"])
    return F.array_join(F.transform(F.array_sort(parts_col), one), ",")


def scan_secrets(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of ``docs`` (all but the text if None) with ``base`` and ``added``, arrays of parts.

    Every row gets its row, those given more than once too; an empty table gives none. A NULL text is an empty one
    without parts, texts of any length are scanned whole. Of equal starts the kind that is listed first comes
    first. Columns named ``base`` and ``added`` give way.
    """
    keep = carried(docs, text_col, keep, "base", "added")
    text = unused("_text", docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, text):
            base, added = zip(*map(_parts, texts))
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in keep), pa.array(base, pa.list_(_PART)), pa.array(added, pa.list_(_PART))],
                [*keep, "base", "added"])

    return docs.select(*keep, F.col(text_col).alias(text)).mapInArrow(
        run, schema_with(docs, keep, f"base {_PARTS}, added {_PARTS}"))


def op4_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    count = lambda kind: F.size(F.filter("base", lambda p: p["kind"] == kind)).cast("long")
    return scan_secrets(docs).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_spans(F.col("base")), 256).alias("base_sha256"), _spans(F.concat("base", "added")).alias("spans"))
