"""SimHash near-dedup: fingerprints linked by a self-join of their binary trie.

The upper part of the trie is walked by Spark: pairs of nodes of equal depth are
joined with their children, differing bits add up, and a pair ends where the error
budget is exceeded. A pair of nodes small enough for one task is handed over with its
fingerprints, and the walk goes on there over sorted arrays. A fingerprint has at most
2,080 others within two bits, so neither the pairs of nodes nor the links grow with the
square of anything.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import ASCII_LOWER, attach, salt_of, schema_with, stored, text_slices, unused
from tidemark.llm.components import components

#: Words of a shingle, seed of its hash, and bits that may differ: the contract of op1.
SHINGLE, SEED, BUDGET = 3, 42, 2

#: Fingerprints of two nodes that one task walks together (256 KB).
LEAF = 32_768

#: Levels that the walk in Spark goes down at a time.
STRIDE = 2

_AT_ONCE = 1 << 16

#: Pairs of nodes that the walk in a task opens at a time. Their children and copies take some 700 bytes a pair, so
#: that a worker needs 25 MB for it.
_FRONTIER = 1 << 15


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash of a text; a bit is set if it is in over half of the shingles' hashes."""
    words = text.encode().translate(ASCII_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), _AT_ONCE):
        spans = zip(starts[at: at + _AT_ONCE].tolist(), ends[at: at + _AT_ONCE].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(joined[s:e], seed) for s, e in spans], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 seed: int = SEED) -> DataFrame:
    """(id, fp) for every row; fp holds the fingerprint's bits as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, text_col):
            fps = np.array([fingerprint(t, shingle, seed) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([rows.column(id_col), pa.array(fps)], [id_col, "fp"])

    return docs.select(id_col, text_col).mapInArrow(run, schema_with(docs, [id_col], "fp long"))


def _node(depth: int) -> Column:
    """The trie node of ``fp`` at a depth: its first bits."""
    return F.shiftrightunsigned("fp", 64 - depth) if depth else F.lit(0).cast("long")


def _leaf_pairs(fps: DataFrame, budget: int, leaf: int, tag: int) -> list[tuple[int, DataFrame]]:
    """(depth, pairs of nodes (a, b, err)) that hold ``leaf`` fingerprints together at most."""
    roots = fps.groupBy(_node(tag).alias("a")).agg(F.count("*").alias("na"))
    pairs = stored(roots.select("a", F.col("a").alias("b"), "na", F.col("na").alias("nb"), F.lit(0).alias("err")), "pairs")
    out = []
    for depth in range(tag, 65, STRIDE):
        size = F.when(F.col("a") == F.col("b"), F.col("na")).otherwise(F.col("na") + F.col("nb"))
        out.append((depth, pairs.filter(size <= leaf).select("a", "b", "err")))
        rest = pairs.filter(size > leaf)
        if rest.isEmpty():
            break
        kids = stored(fps.groupBy(_node(depth + STRIDE).alias("kid")).agg(F.count("*").alias("n")), "nodes")
        parent = F.shiftrightunsigned("kid", STRIDE)
        left = kids.select(parent.alias("a"), F.col("kid").alias("ka"), F.col("n").alias("kna"))
        right = kids.select(parent.alias("b"), F.col("kid").alias("kb"), F.col("n").alias("knb"))
        below = F.col("ka").bitwiseXOR(F.col("kb")).bitwiseAND(F.lit((1 << STRIDE) - 1))  # bits that the parents lack
        err = F.col("err") + F.bit_count(below)
        pairs = stored(
            rest.join(left, "a").join(right, "b").filter((F.col("ka") <= F.col("kb")) | (F.col("a") != F.col("b")))
            .filter(err <= budget)
            .select(F.col("ka").alias("a"), F.col("kb").alias("b"), F.col("kna").alias("na"),
                    F.col("knb").alias("nb"), err.alias("err")), "pairs")
    return out


def walk(a: np.ndarray, b: np.ndarray, depth: int, err: int, budget: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of fingerprints within ``budget`` bits below two nodes of equal depth.

    ``a`` and ``b`` are sorted arrays without repeats; a node is a range of them.
    ``same``: both are one node, whose pairs count once.
    """
    zeros: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def zeros_before(level: int) -> tuple[np.ndarray, np.ndarray]:
        if level not in zeros:
            bit = np.uint64(1 << (63 - level))
            one = lambda x: np.concatenate(([0], np.cumsum((x & bit) == 0)))
            zeros[level] = (left := one(a), left if same else one(b))
        return zeros[level]

    stack = [(depth, np.array([[0, len(a), 0, len(b), err]], np.int64))]
    while stack:
        level, front = stack.pop()
        lo, hi, lo2, hi2, bits = front.T
        single = (hi - lo == 1) & (hi2 - lo2 == 1)
        if single.any():
            x, y = a[lo[single]], b[lo2[single]]
            near = np.bitwise_count(x ^ y) <= budget
            if same:
                near &= lo[single] != lo2[single]
            if near.any():
                yield x[near], y[near]
            front = front[~single]
            lo, hi, lo2, hi2, bits = front.T
        if not len(front) or level == 64:
            continue
        if len(front) > _FRONTIER:
            stack += [(level, half) for half in np.array_split(front, 2)]
            continue
        za, zb = zeros_before(level)
        mid, mid2 = lo + za[hi] - za[lo], lo2 + zb[hi2] - zb[lo2]
        self_pair = (lo == lo2) if same else np.zeros(len(front), bool)
        kids = np.concatenate([
            np.stack([lo, mid, lo2, mid2, bits], 1), np.stack([mid, hi, mid2, hi2, bits], 1),
            np.stack([lo, mid, mid2, hi2, bits + 1], 1),
            np.stack([mid, hi, lo2, mid2, bits + 1], 1)[~self_pair]])
        stack.append((level + 1, kids[(kids[:, 0] < kids[:, 1]) & (kids[:, 2] < kids[:, 3]) & (kids[:, 4] <= budget)]))


def trie_links(fps: DataFrame, budget: int = BUDGET, leaf: int = LEAF, tag: int = 0) -> DataFrame:
    """(a, b): every unordered pair of different values of ``fps`` (fp, without repeats) within ``budget`` bits.

    The first ``tag`` bits (an even number) name a trie of their own: fingerprints that
    differ in them never meet.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                one, two = (np.sort(row[c].values.to_numpy().view(np.uint64)) for c in ("fa", "fb"))
                same = row["a"].as_py() == row["b"].as_py()
                for x, y in walk(one, two, row["depth"].as_py(), row["err"].as_py(), budget, same):
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], ["a", "b"])

    work = None
    for depth, pairs in _leaf_pairs(fps, budget, leaf, tag):
        used = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        nodes = fps.withColumn("node", _node(depth)).join(used, "node").groupBy("node").agg(
            F.collect_list("fp").alias("fps"))
        each = (
            pairs.join(nodes.select(F.col("node").alias("a"), F.col("fps").alias("fa")), "a")
            .join(nodes.select(F.col("node").alias("b"), F.col("fps").alias("fb")), "b")
            .select(F.lit(depth).alias("depth"), "a", "b", "err", "fa", "fb"))
        work = each if work is None else work.unionByName(each)
    return work.repartition("depth", "a", "b").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = BUDGET,
                    shingle: int = SHINGLE, seed: int = SEED, leaf: int = LEAF) -> DataFrame:
    """(id, fingerprint, component_id, links) for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links, ``links`` the number of
    other fingerprints linked to the row's own. NULL ids are never the smallest; texts
    that are NULL or hold no word have the fingerprint zero and link like others. Rows
    given more than once each get their row. An empty table gives no rows.
    """
    rows = stored(fingerprints(docs, id_col, text_col, shingle, seed).withColumnRenamed(id_col, "id"), "fingerprints")
    fps = stored(rows.groupBy("fp").agg(F.min("id").alias("least")), "fps")
    links = stored(trie_links(fps.select("fp"), budget, leaf), "links")
    roots = components(links).select(F.col("node").alias("fp"), "root")
    degrees = links.select(F.explode(F.array("a", "b")).alias("fp")).groupBy("fp").agg(F.count("*").alias("links"))
    linked = fps.join(roots, "fp").join(degrees, "fp")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = stored(linked.join(least, "root").select("fp", "component_id", "links"), "classes")
    # The classes ride along as rows of the same key, so that no fingerprint's copies meet in one task.
    member = rows.select("id", "fp", F.lit(None).cast("long").alias("links"), F.col("id").alias("component_id"))
    head = classes.select(F.lit(None).cast(rows.schema["id"].dataType).alias("id"), "fp", "links", "component_id")
    every = member.withColumn("head", F.lit(False)).unionByName(head.withColumn("head", F.lit(True)))
    found = attach(every.withColumn("salt", salt_of("id")), ["fp"], "salt",
                   {"c": F.min("component_id"), "l": F.max("links")},
                   {"component_id": F.min("c"), "links": F.max("l")})
    return found.filter("NOT head").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("links"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how: int) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component; rows with a NULL id stay."""
    classes = near_duplicates(docs, id_col, text_col, **how)
    name = unused("_gone", docs)
    gone = classes.filter(F.col("component_id") < F.col(id_col)).select(F.col(id_col).alias(name)).distinct()
    return docs.join(gone, F.col(id_col) == F.col(name), "left_anti")


def op1_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
