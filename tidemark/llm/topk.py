"""Exact top-k search by exhaustive term-at-a-time accumulation.

Candidates are packed into blocks that hold, for each term (vector position), the
postings: which of the block's vectors have it, and with what weight. Blocks of
queries meet every block of candidates; term by term the queries' weights times the
postings are scattered into dense score arrays, the best of a block are selected by
partition, and the selections of all blocks are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import stored

#: Factor before rounding down, results of a query, and the stride of ids that are queries.
SCALE, TOP, EVERY = 1024, 10, 100

#: Vectors in a block of candidates and in a block of queries: 16 MB of scores at a time.
BLOCK, QUERIES = 4096, 512

_BLOCK = "ids binary, width int, weights binary"


def _scaled(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def _sound(vector: Column) -> Column:
    """Whether a vector exists and all its components are finite numbers."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad)


def _pack(size: int):
    """Rows (id, terms) as blocks of ``size`` vectors: ids, and a matrix with a row for each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                terms = part.column("terms")
                lengths = np.diff(terms.offsets.to_numpy())
                flat = terms.flatten().to_numpy()
                width = int(lengths.max(initial=0))
                weights = np.zeros((part.num_rows, width), np.int64)
                weights[np.arange(width) < lengths[:, None]] = flat
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.column("id").to_numpy().tobytes()], pa.binary()), pa.array([width], pa.int32()),
                     pa.array([np.ascontiguousarray(weights.T).tobytes()], pa.binary())], ["ids", "width", "weights"])

    return run


def accumulate(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Scores of all queries against all candidates; both are (terms, vectors) matrices of integers."""
    width = min(len(queries), len(candidates))
    largest = int(np.abs(queries).max(initial=0)) * int(np.abs(candidates).max(initial=0)) * max(1, width)
    if largest >= 1 << 63:
        raise OverflowError("scores beyond 64 bits")
    scores = np.zeros((queries.shape[1], candidates.shape[1]), np.int64)
    for term in range(width):
        asked, posted = np.flatnonzero(queries[term]), np.flatnonzero(candidates[term])
        weights = candidates[term, posted]
        for q in asked:
            if len(posted) == len(candidates[term]):
                scores[q] += queries[term, q] * weights
            else:
                scores[q, posted] += queries[term, q] * weights
    return scores


def best_of(scores: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Positions of the ``top`` highest scores, ties to the smaller id, in no order."""
    if len(scores) <= top:
        return np.arange(len(scores))
    least = np.partition(scores, len(scores) - top)[len(scores) - top]
    above, level = np.flatnonzero(scores > least), np.flatnonzero(scores == least)
    level = level[np.argsort(ids[level], kind="stable")[: top - len(above)]]
    return np.concatenate([above, level])


def _search(top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, asked = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["q_ids"], np.int64)
                scores = accumulate(np.frombuffer(row["q_weights"], np.int64).reshape(row["q_width"], len(asked)),
                                    np.frombuffer(row["weights"], np.int64).reshape(row["width"], len(ids)))
                out = []
                for q, query in enumerate(asked):
                    others = np.flatnonzero(ids != query)
                    best = others[best_of(scores[q, others], ids[others], top)]
                    out.append((np.full(len(best), query), np.full(len(best), row["q_block"]), np.full(len(best), q),
                                ids[best], scores[q, best]))
                columns = [pa.array(np.concatenate(c)) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "q_block", "query", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, top: int = TOP, scale: int = SCALE, id_col: str = "vec_id",
          vector_col: str = "embedding", block: int = BLOCK, query_block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` candidates of every query by integer inner product.

    Components become floor(scale * x). All rows of ``vectors`` but those with the
    query's own id compete; ties go to the smaller id. Vectors that are NULL or hold a
    NULL or a number that is not finite take no part, nor do rows without an id; a
    vector shorter than another counts as zero beyond its end. A row given more than
    once competes each time; a query given more than once is answered once for each
    different vector. Scores beyond 64 bits raise OverflowError. No queries or no
    candidates give no rows.
    """

    def sound(df: DataFrame) -> DataFrame:
        df = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
        return df.filter(F.col("id").isNotNull() & _sound(F.col("v"))).select("id", _scaled(F.col("v"), scale).alias("terms"))

    packed = stored(sound(vectors).mapInArrow(_pack(block), _BLOCK), "candidates")
    asked = stored(sound(queries).dropDuplicates(["id", "terms"]).mapInArrow(_pack(query_block), _BLOCK), "queries")
    asked = stored(asked.withColumn("number", F.monotonically_increasing_id()), "queries")
    places = asked.select("number", (F.row_number().over(Window.orderBy("number")) - 1).cast("long").alias("q_block"))
    asked = stored(asked.join(places, "number").drop("number"), "queries")  # numbered from 0: a number for each block
    # A block of queries for each block of candidates: the stated query set against all rows.
    numbers = packed.select("ids", "width", "weights", F.monotonically_increasing_id().alias("block"))
    blocks = asked.count()
    deals = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))) if blocks else F.lit(None).cast("long")
    work = numbers.withColumn("q_block", deals).join(
        asked.select("q_block", F.col("ids").alias("q_ids"), F.col("width").alias("q_width"),
                     F.col("weights").alias("q_weights")), "q_block")
    found = work.repartition("q_block", "block").mapInArrow(
        _search(top), "query_id long, q_block long, query long, vec_id long, score long")
    order = Window.partitionBy("query_id", "q_block", "query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op6_exact_top_k(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, vectors.filter(F.col("vec_id") % EVERY == 0))


SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % {EVERY} = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {TOP}
"""
