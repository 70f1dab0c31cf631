"""The operators' queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidemark.llm import bpe, exact_dedup, jaccard, langid, lexical, lm, mixing, repair, secrets, simhash, token_counts, topk, warc
from tidemark.session import pin_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_simhash_near_dedup": simhash.op1_simhash_near_dedup,
    "op2_warc": warc.op2_warc,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_secret_scan": secrets.op4_secret_scan,
    "op5_token_rollups": token_counts.op5_token_rollups,
    "op6_exact_top_k": topk.op6_exact_top_k,
    "op7_mix_sources": mixing.op7_mix_sources,
    "op8_lm_score": lm.op8_lm_score,
    "op9_byte_bpe": bpe.op9_byte_bpe,
    "op10_language_id": langid.op10_language_id,
    "op11_jaccard_join": jaccard.op11_jaccard_join,
    "op12_conversation_repair": repair.op12_conversation_repair,
    "op13_lexical_search": lexical.op13_lexical_search,
    "pipeline": corpus_pipeline.run,
}

SQL: dict[str, str] = {
    "op2_warc": warc.SQL,
    "op3_exact_dedup": exact_dedup.SQL,
    "op6_exact_top_k": topk.SQL,
    "op7_mix_sources": mixing.SQL,
    "op11_jaccard_join": jaccard.SQL,
    "op12_conversation_repair": repair.SQL,
    "op13_lexical_search": lexical.SQL,
}


def _in_utc(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pin_utc(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: _in_utc(query) for name, query in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
