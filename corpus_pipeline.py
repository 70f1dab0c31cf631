"""A corpus through five stages: language, exact copies, near copies, mixture, tokens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, exact_dedup, langid, mixing, near_copies as near
from tidemark.llm.common import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language that their labels teach; those without a letter go."""
    labelled = docs.filter(~langid.held_out(F.col("doc_id")))
    return langid.keep_known(docs, langid.fit(labelled))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal but for white space the longest stays, of equally long ones the smallest id."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share 0.8 or more of their five-word shingles the smallest id stays."""
    return near.drop_near_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks for, in random order; a copy keeps its id."""
    return mixing.mix(docs).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the ids of each text, and whether they decode to it."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.round_trip(docs, path, public_tokenizers.PATTERN, keep=docs.columns)
    return coded.withColumn("n_tokens", F.size("ids").cast("long")).withColumn(
        "round_trip", F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).drop("decoded")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("mix_sources", mixture),
    ("byte_bpe", tokens),
]

#: SimHash, language ID and BPE are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
