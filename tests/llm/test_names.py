"""Columns that are named like an operator's working columns come through unharmed."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, exact_dedup, langid, lm, mixing, near_copies, secrets, simhash, token_counts

NAMES = ["_text", "_row", "_known", "_base", "_rare", "_levels", "_more", "_rest", "_key", "_steps", "_sums", "_order", "_own", "_salt",
         "_id", "_hash", "_rows", "_kept", "_gone", "_ids", "_rank", "_most", "_salts", "_k0", "id", "chars", "norm", "len", "slot", "page",
         "bitmap", "survives", "full_hash", "best", "kept", "fp", "fps", "key", "root", "node", "least", "shingles", "n", "mean", "weight",
         "hash", "rank", "most", "ids2", "word", "times", "row", "salt", "head", "component_id"]
PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
TEXTS = ["the cat sat on the mat today", "le chat est sur le tapis rouge", "user=alice password=hunter22", "", None, "the cat sat on the  mat today",
         "the dog ran off with the old red ball"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i != 1 else "fr", "s") for i, t in enumerate(TEXTS)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return plain.select("*", *(F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")).alias(c) for c in NAMES))


def _lm(docs):
    model, vocabulary = lm.train(docs)
    return lm.score(docs, model, vocabulary, docs.columns)


def _lm_in_passes(docs):
    model, vocabulary = lm.train(docs, pass_bytes=200)
    return lm.score(docs, model, vocabulary, docs.columns)


RUNS = {
    "secrets": secrets.scan_secrets,
    "predict": lambda d: langid.predict(d, langid.fit(d)),
    "keep_known": lambda d: langid.keep_known(d, langid.fit(d), 0.0),
    "encode": lambda d: bpe.encode(d, PATH, PATTERN),
    "decode": lambda d: bpe.decode(bpe.encode(d, PATH, PATTERN), PATH),
    "round_trip": lambda d: bpe.round_trip(d, PATH, PATTERN),
    "bpe_count": lambda d: token_counts.bpe_count(d, PATH, PATTERN),
    "score": _lm,
    "score_in_passes": _lm_in_passes,
    "mix": lambda d: mixing.mix(d, epochs=3.0),
    "drop_copies": exact_dedup.drop_copies,
    "drop_near_duplicates": simhash.drop_near_duplicates,
    "drop_near_copies": near_copies.drop_near_copies,
}


@pytest.mark.parametrize("name", list(RUNS))
def test_columns_by_working_names(docs, name):
    got = RUNS[name](docs).collect()
    assert got
    for r in got:
        assert [r[c] for c in NAMES] == [f"{c}:{r.doc_id}" for c in NAMES]
