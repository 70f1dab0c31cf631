"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Built-in functions only. Every step is a narrow scan of the documents and an
aggregation of a few numbers for each row; texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import BLANKS, attach, salt_of, stored, unused

#: Characters of the normalised text that the second step hashes.
PREFIX = 64

#: Bits of the filter that carries the surviving groups to the next scan. It is sent to
#: the executors as 4 KB pages: 8 MB at most, whatever the input.
FILTER_BITS = 1 << 26

_PAGE = 8 * 4096


def normalised(text: Column) -> Column:
    """The text without spaces, tabs and line ends; NULL counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def _slot(*key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(bits))


def _marked(groups: DataFrame, bits: int) -> DataFrame:
    """The slots of ``groups`` as a table of bitmap pages: at most ``bits / 32768`` rows of 4 KB."""
    return groups.groupBy((F.col("slot") / _PAGE).cast("int").alias("page")).agg(
        F.bitmap_construct_agg((F.col("slot") % _PAGE)).alias("bitmap"))


def _with_survival(rows: DataFrame, slot: Column, pages: DataFrame) -> DataFrame:
    """``rows`` with ``survives``: whether the slot's bit is set. Other groups may share a slot, none is lost."""
    byte = F.conv(F.hex(F.substring("bitmap", (F.col("slot") % _PAGE / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    bit = F.coalesce(F.getbit(byte, (F.col("slot") % 8).cast("int")), F.lit(0)) == 1
    return (
        rows.withColumn("slot", slot)
        .withColumn("page", (F.col("slot") / _PAGE).cast("int"))
        .join(F.broadcast(pages), "page", "left")
        .withColumn("survives", bit)
        .drop("slot", "page", "bitmap")
    )


def _repeated(rows: DataFrame, *keys: str, bits: int) -> DataFrame:
    groups = rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    return groups.select(_slot(*map(F.col, keys), bits=bits).alias("slot"))


def refine(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX,
           bits: int = FILTER_BITS, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per document: id, ``chars``, ``full_hash`` (NULL: no other document can equal it), ``carry``.

    Step one counts the normalised lengths. Step two hashes a prefix where the length
    recurs and counts (length, prefix). Step three hashes the whole text only where
    both recur. What a step passes on is a bitmap of fixed size, so each step is one
    scan without a join of documents.
    """
    norm = normalised(F.col(text_col))
    carry = carry or {}
    base = docs.select(
        F.col(id_col).alias("id"), F.char_length(F.coalesce(F.col(text_col), F.lit(""))).alias("chars"),
        norm.alias("norm"), *(c.alias(n) for n, c in carry.items()))
    rows = base.withColumn("len", F.char_length("norm"))
    by_length = stored(_marked(_repeated(rows, "len", bits=bits), bits), "lengths")
    rows = _with_survival(rows, _slot(F.col("len"), bits=bits), by_length)
    rows = rows.withColumn("head", F.when(F.col("survives"), F.xxhash64(F.substring("norm", 1, prefix)))).drop("survives")
    heads = rows.filter(F.col("head").isNotNull())
    by_head = stored(_marked(_repeated(heads, "len", "head", bits=bits), bits), "prefixes")
    rows = _with_survival(rows, _slot(F.col("len"), F.col("head"), bits=bits), by_head)
    full = F.when(F.col("survives") & F.col("head").isNotNull(), F.sha2("norm", 256))
    return rows.select("id", "chars", full.alias("full_hash"), *carry)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                carry: dict[str, Column] | None = None, **steps: int) -> DataFrame:
    """(id, keep_id, group_size, kept) and the ``carry`` columns for every row of ``docs``.

    Texts are equal when they match after deleting white space. The row with the most
    characters stays, then that with the smallest id; NULL ids come last, and a NULL
    text is an empty one. Rows that agree in id and length tie and are all kept: they
    stand for one document given more than once. An empty table gives no rows.
    """
    carry = carry or {}
    rows = stored(refine(docs, id_col, text_col, carry=carry, **steps), "refined")
    best = F.struct((-F.col("chars")).alias("c"), F.col("id").isNull().alias("n"), F.col("id").alias("id"))
    groups = attach(
        rows.filter("full_hash IS NOT NULL").withColumn("salt", salt_of("id", "chars")), ["full_hash"], "salt",
        {"b": F.min(best), "n": F.count("*")}, {"best": F.min("b"), "group_size": F.sum("n")})
    kept = F.col("chars").eqNullSafe(-F.col("best.c")) & F.col("id").eqNullSafe(F.col("best.id"))
    copies = groups.select("id", F.col("best.id").alias("keep_id"), "group_size", kept.alias("kept"), *carry)
    single = rows.filter("full_hash IS NULL").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        *carry)
    return copies.unionByName(single).withColumnRenamed("id", id_col)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **steps: int) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    A row given more than once, with the same id and the same text, stays once.
    """
    text_hash = F.sha2(normalised(F.col(text_col)), 256)
    marks = stored(exact_dedup(docs, id_col, text_col, carry={"_hash": text_hash}, **steps), "marks")
    one, two, count, own, row = (unused(n, docs) for n in ("_id", "_hash", "_rows", "_own", "_row"))
    marks = marks.groupBy(F.col(id_col).alias(one), F.col("_hash").alias(two)).agg(
        F.count_if("kept").alias("kept"), F.count("*").alias(count)).filter("kept > 0").drop("kept")
    rows = docs.withColumn(own, text_hash).join(
        marks, F.col(id_col).eqNullSafe(F.col(one)) & (F.col(own) == F.col(two)))
    longest = F.max_by(F.struct(*docs.columns), F.char_length(F.coalesce(text_col, F.lit(""))))
    again = rows.filter(F.col(count) > 1).groupBy(one, two).agg(longest.alias(row)).select(f"{row}.*")
    return rows.filter(F.col(count) == 1).select(docs.columns).unionByName(again)


def op3_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_dedup(docs, carry={"text_sha256": F.sha2(normalised(F.col("text")), 256)})


SQL = r"""
WITH n AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
k AS (
  SELECT doc_id, norm,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(t) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM k
"""
