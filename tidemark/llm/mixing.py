"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import lookup, unused

#: Exponent that turns sizes into target weights where none are given: below 1 it lifts
#: small sources.
SMOOTHING = 0.7

#: Copies of all documents over documents, on average.
EPOCHS = 1.0

SEED = "mix-1"

#: Largest mean that one inversion takes; a larger one is the sum of several.
STEP = 16.0

#: Values of a distribution that are listed; beyond them less than 1e-14 is left.
TERMS = 80


def uniform(seed: str, *keys: Column) -> Column:
    """A number in [0, 1) from 52 bits of the MD5 of seed and keys: the same on any engine."""
    text = F.concat_ws(":", F.lit(seed), *(F.coalesce(k.cast("string"), F.lit("null")) for k in keys))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def cumulative(mean: Column) -> Column:
    """The first ``TERMS`` cumulative probabilities of a Poisson distribution, as an array."""
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), first.alias("sum"), F.array(first).alias("all"))

    def more(s: Column, k: Column) -> Column:
        p = s["p"] * mean / k
        return F.struct(p.alias("p"), (s["sum"] + p).alias("sum"), F.concat(s["all"], F.array(s["sum"] + p)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS - 1)), start, more)["all"]


def source_rates(docs: DataFrame, source_col: str = "source", weights: dict[str, float] | None = None,
                 epochs: float = EPOCHS, smoothing: float = SMOOTHING) -> DataFrame:
    """(source, n, mean): how often a document of each source is to appear on average.

    ``epochs`` times all documents are dealt to the sources by their share of the
    weights: the given ones, where a source that is not named gets nothing, or else
    the number of its documents to the power ``smoothing``.
    """
    sizes = docs.groupBy(source_col).agg(F.count("*").alias("n"))
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(smoothing))
    elif weights:
        named = F.create_map(*(F.lit(x) for name, w in weights.items() for x in (name, float(w))))
        weight = F.coalesce(F.try_element_at(named, F.col(source_col)), F.lit(0.0))
    else:
        weight = F.lit(0.0)
    sizes = sizes.withColumn("weight", weight)
    sums = sizes.agg(F.sum("n").alias("n"), F.sum("weight").alias("weight")).first()
    scale = epochs * sums.n / sums.weight if sums.weight else 0.0
    return sizes.select(source_col, "n", (F.col("weight") * F.lit(scale) / F.col("n")).alias("mean"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = EPOCHS,
        smoothing: float = SMOOTHING, seed: str = SEED, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """``docs`` with each row repeated by its Poisson count, dealt and sorted by a hash.

    Adds ``copy`` (from 0) and ``copies``; columns of ``docs`` by these names give way.
    The count depends on the seed and the id alone, so rows given more than once are
    repeated alike, and a task that runs again makes the same copies. A NULL source is
    a source of its own (weights cannot name it); a NULL id hashes as the text
    ``null``. Texts play no part. An empty table gives no rows.
    """
    columns = [c for c in docs.columns if c not in ("copy", "copies")]
    steps = F.greatest(F.lit(1), F.ceil(F.col("mean") / STEP).cast("int"))
    times, sums, place = (unused(n, docs) for n in ("_steps", "_sums", "_order"))
    table = source_rates(docs.select(source_col), source_col, weights, epochs, smoothing).select(
        source_col, steps.alias(times), cumulative(F.col("mean") / steps).alias(sums))
    rows = lookup(docs.select(columns), table, source_col, id_col)

    def draw(step: Column) -> Column:
        u = uniform(seed, F.col(id_col), step)
        return F.size(F.filter(sums, lambda c: c <= u))

    count = F.aggregate(F.transform(F.sequence(F.lit(1), F.col(times)), draw), F.lit(0), lambda a, b: a + b)
    rows = rows.withColumn("copies", count).filter("copies > 0")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    order = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), "copy"))
    return (
        rows.withColumn(place, order).repartition(place).sortWithinPartitions(place)
        .select(*columns, "copy", "copies")
    )


def op7_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: For means of 16 at most, as with the given tables.
SQL = f"""
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
m AS (SELECT source, pow(n, {SMOOTHING}) * ({EPOCHS} * sum(n) OVER () / sum(pow(n, {SMOOTHING})) OVER ()) / n AS mean FROM n),
p AS (SELECT source, k, exp(-mean + k * ln(mean) - CASE WHEN k = 0 THEN 0 ELSE lgamma(k + 1) END) AS p
      FROM m, range(0, {TERMS}) AS r(k)),
c AS (SELECT source, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM p),
u AS (SELECT *, CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':1'), 1, 13) AS BIGINT)
             / 4503599627370496.0 AS u FROM documents),
d AS (SELECT u.*, (SELECT count(*) FROM c WHERE c.source IS NOT DISTINCT FROM u.source AND c.c <= u.u) AS copies FROM u)
SELECT doc_id, text, lang, source, n_chars, CAST(unnest(range(0, copies)) AS INTEGER) AS copy, CAST(copies AS INTEGER) AS copies FROM d
"""
