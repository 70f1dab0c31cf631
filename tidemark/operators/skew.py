"""Lookup join that holds when one key has a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def lookup_join(rows: DataFrame, lookup: DataFrame, key: str, weight: str, spread_by: str,
                rows_per_split: int = 2_000_000) -> DataFrame:
    """``rows LEFT JOIN lookup USING (key)`` with hot and NULL keys spread over tasks.

    ``lookup`` has one row per key and ``weight``, the key's number of rows. A
    key with more than ``rows_per_split`` rows is stored once per split, and its
    rows choose a split by the hash of ``spread_by``. The list of hot keys is
    broadcast: its length is at most (number of rows / rows_per_split), five
    hundred for a billion rows. NULL keys match nothing and are spread as well.
    """
    splits = F.ceil(F.col(weight) / F.lit(rows_per_split)).cast("int")
    hot = (
        lookup.filter(F.col(key).isNotNull() & (F.col(weight) > rows_per_split))
        .select(key, splits.alias("_splits"))
    )
    spread = F.xxhash64(spread_by)
    split = F.when(F.col(key).isNull(), F.pmod(spread, F.lit(4096))).otherwise(
        F.pmod(spread, F.coalesce("_splits", F.lit(1))))
    copies = lookup.withColumn("_split", F.explode(F.sequence(F.lit(0), F.greatest(splits, F.lit(1)) - 1)))
    return (
        rows.join(F.broadcast(hot), key, "left")
        .withColumn("_split", split.cast("int"))
        .join(copies.drop(weight), [key, "_split"], "left")
        .drop("_split", "_splits")
    )
