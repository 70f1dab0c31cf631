"""Token counts kept as rollups that signed changes update.

A ledger holds one small table for each committed batch, the batch's sums by source,
language and tokenizer version, and the totals of the batches that were folded. Inserts
(+1), deletes (-1) and revised counts (-1 old, +1 new) may come in any order. A batch
counts once its table has Spark's ``_SUCCESS`` mark; committing it again does nothing,
and a batch that was cut short is written anew. Folding adds batches to the totals and
notes their names in the same write, so a batch counts either by itself or in the totals.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import BLANKS, carried, discard, schema_with, shared_path, stored, text_slices, unused

KEYS = ("source", "lang", "tokenizer")
SUMS = ("docs", "tokens", "chars")

#: Characters for each token, to estimate counts until texts are encoded.
CHARS_PER_TOKEN = 4

_BATCH = "source string, lang string, tokenizer string, docs long, tokens long, chars long"


@lru_cache(maxsize=4)
def _encoding(path: str, pattern: str):
    import tiktoken

    from tidemark.llm.bpe import read_ranks

    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})


def word_count(text: Column) -> Column:
    """Words between white space; none for NULL."""
    plain = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), f"[{BLANKS}]+", " "))
    return F.when(plain == "", 0).otherwise(F.size(F.split(plain, " "))).cast("long")


def bpe_count(docs: DataFrame, path: str, pattern: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of ``docs`` with ``tokens``, by a rank file that every executor has; 0 for NULL.

    Texts are counted whole, rows given more than once each get their row, an empty table gives none; a column
    named ``tokens`` gives way.
    """
    keep = carried(docs, text_col, keep, "tokens")
    text = unused("_text", docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(path, pattern).encode_ordinary
        for rows, texts in text_slices(batches, text):
            counts = pa.array([len(encode(t)) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in keep), counts], [*keep, "tokens"])

    inputs = docs.select(*keep, F.col(text_col).alias(text))
    return inputs.mapInArrow(run, schema_with(docs, keep, "tokens long"))


def signed(counts: DataFrame, sign: int) -> DataFrame:
    """Counted documents (source, lang, tokenizer, tokens, chars) as changes: +1 adds them, -1 takes them away."""
    return counts.select(*KEYS, F.lit(sign).alias("sign"), "tokens", "chars")


def revised(before: DataFrame, after: DataFrame) -> DataFrame:
    """The changes from one count of documents to another; either may move them between keys."""
    return signed(before, -1).unionByName(signed(after, 1))


#: Rows of the folded table: sums where ``batch`` is NULL, else the name of a batch that is in the sums.
_FOLDED = f"batch string, {_BATCH}"


def _complete(spark: SparkSession, folder: str) -> list[str]:
    """The names of complete tables in a folder, in order: those of batches that are not folded yet, or of totals."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(path):
        return []
    own = [status.getPath().getName() for status in store.listStatus(path)]
    return sorted(n for n in own if store.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}/_SUCCESS")))


def _folded(spark: SparkSession, ledger: str) -> tuple[DataFrame, int]:
    """The newest totals and their number; empty ones of number 0 at first."""
    known = _complete(spark, f"{ledger}/totals")
    if not known:
        return spark.createDataFrame([], _FOLDED), 0
    return spark.read.schema(_FOLDED).parquet(f"{ledger}/totals/{known[-1]}"), int(known[-1])


def _open(spark: SparkSession, ledger: str, folded: DataFrame) -> list[str]:
    """Committed batches that the totals lack."""
    names = _complete(spark, f"{ledger}/batches")
    done = {r.batch for r in folded.filter(F.col("batch").isin(names)).select("batch").collect()} if names else set()
    return [n for n in names if n not in done]


def commit(changes: DataFrame, ledger: str, batch: str) -> bool:
    """Adds a batch of signed changes to the ledger; false where it was committed before.

    NULL sources and languages are keys of their own, NULL counts add nothing. An empty
    batch is committed as well. One writer commits a batch at a time.
    """
    if not batch or not all(c.isalnum() or c in "-_." for c in batch) or batch[0] in "._":
        raise ValueError(f"not a batch name: {batch!r}")
    spark = changes.sparkSession
    if batch in _complete(spark, f"{ledger}/batches") or not _folded(spark, ledger)[0].filter(F.col("batch") == batch).isEmpty():
        return False
    add = lambda c: F.coalesce(F.sum(F.col("sign") * c), F.lit(0)).cast("long")
    sums = changes.groupBy(*KEYS).agg(
        F.sum("sign").cast("long").alias("docs"), add(F.col("tokens")).alias("tokens"), add(F.col("chars")).alias("chars"))
    sums.write.mode("overwrite").parquet(f"{ledger}/batches/{batch}")
    return True


def _sums(spark: SparkSession, ledger: str, folded: DataFrame, names: list[str]) -> DataFrame:
    every = folded.filter("batch IS NULL").drop("batch")
    if names:
        every = every.unionByName(spark.read.schema(_BATCH).parquet(*(f"{ledger}/batches/{n}" for n in names)))
    return every.groupBy(*KEYS).agg(*(F.sum(c).alias(c) for c in SUMS)).filter(" OR ".join(f"{c} <> 0" for c in SUMS))


def fold(spark: SparkSession, ledger: str) -> int:
    """Adds the open batches to the totals and drops their tables; their number. One run at a time folds a ledger."""
    folded, number = _folded(spark, ledger)
    names = _open(spark, ledger, folded)
    if names:
        marks = spark.createDataFrame([(n,) for n in names], "batch string")
        noted = folded.filter("batch IS NOT NULL").unionByName(marks, allowMissingColumns=True)
        rows = _sums(spark, ledger, folded, names).withColumn("batch", F.lit(None).cast("string"))
        rows.unionByName(noted).write.mode("overwrite").parquet(f"{ledger}/totals/{number + 1:08d}")
        for old in _complete(spark, f"{ledger}/totals")[:-1]:
            discard(spark, f"{ledger}/totals/{old}")
    for name in set(_complete(spark, f"{ledger}/batches")) - set(_open(spark, ledger, _folded(spark, ledger)[0])):
        discard(spark, f"{ledger}/batches/{name}")
    return len(names)


def totals(spark: SparkSession, ledger: str) -> DataFrame:
    """Sums over all committed batches, folded or not; keys that came to nothing are left out."""
    folded, _ = _folded(spark, ledger)
    return _sums(spark, ledger, folded, _open(spark, ledger, folded))


def op5_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are loaded by estimate, revised when encoded, and those labelled toxic are taken down.

    Words are counted under a tokenizer version of their own. Each batch is handed in
    twice, as after a retry: the first also after it was folded into the totals.
    """
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    chars = F.char_length(F.coalesce("text", F.lit(""))).cast("long")
    rows = docs.withColumn("chars", chars).withColumn("words", word_count(F.col("text")))
    counted = stored(bpe_count(rows, path, pattern), "counts")

    def version(name: str, tokens: Column, of: DataFrame = counted) -> DataFrame:
        return of.select("source", "lang", F.lit(name).alias("tokenizer"), tokens.alias("tokens"), "chars")

    estimate = version("byte_bpe_50k", F.ceil(F.col("chars") / CHARS_PER_TOKEN))
    exact, words = version("byte_bpe_50k", F.col("tokens")), version("words", F.col("words"))
    toxic = labels.filter("toxic = 1").select("doc_id").distinct()
    gone = counted.join(toxic, "doc_id", "left_semi")
    down = version("byte_bpe_50k", F.col("tokens"), gone).unionByName(version("words", F.col("words"), gone))
    batches = {
        "load": signed(estimate.unionByName(words), 1),
        "take-down": signed(down, -1),
        "revise": revised(estimate, exact),
    }
    ledger = shared_path(spark, "ledger")
    for name, changes in [*batches.items(), *batches.items()]:
        if commit(changes, ledger, name) and name == "load":
            fold(spark, ledger)
    return totals(spark, ledger)
