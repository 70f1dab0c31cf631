"""Near copies: texts that share most of their five-word shingles, found by SimHash.

A SimHash of shingles is too far off at a similarity of 0.8 (some 8 of 64 bits), one of
distinct words is not (some 4). So each text has several fingerprints of its words, each
in a trie of its own, and the trie self-join proposes pairs within a few bits. Every
pair is then judged by the shingles themselves, unless its texts are connected by then.
Texts that share or link a fingerprint meet its first text first, and each other in later
rounds as long as they are not connected. Sizes and parities of the shingles tell most
pairs that cannot be near copies before the shingles are fetched; no pair is judged twice. Short texts, whose fingerprints are too far off,
also meet by their rarest shingles, which no pair of near copies can lack.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import ASCII_LOWER, attach, drop_stored, salt_of, schema_with, stored, text_slices, unused
from tidemark.llm.components import components
from tidemark.llm.jaccard import BITS, FEW, _plausible, _prefixed, parity
from tidemark.llm.simhash import LEAF, trie_links

#: Words of a shingle and the share of shingles that near copies have in common.
SHINGLE, SIMILARITY = 5, 0.8
PERCENT = round(100 * SIMILARITY)

#: Texts of a fingerprint that one copy of another's texts meets.
SIDE = 4096

#: Fingerprints of a text, bits that may differ, and leading bits that number the tries.
TREES, BUDGET, TAG = 6, 3, 4

#: Partners that a text is judged against in the first round, and how that grows by the round.
FAN, GROWTH = 8, 16

#: Pairs that one copy of a text's shingles serves.
SHARE = 4096

#: Shingles of a short text: pairs with one of these are proposed without fail.
SHORT = 80

_AT_ONCE = 1 << 16
_GOLDEN = 0x9E3779B97F4A7C15


def _mixed(hashes: np.ndarray, seed: int) -> np.ndarray:
    """Other hashes for another seed."""
    x = hashes ^ np.uint64(_GOLDEN * (seed + 1) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sketch(text: str, trees: int = TREES, shingle: int = SHINGLE) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(key, fingerprints, shingles) of a text.

    The key is equal for texts with the same words in the same order. The first bits of
    a fingerprint number its trie. Shingles are distinct 32-bit hashes in order; a text
    with fewer words has one, of all its words, and a text without words none.
    """
    words = text.encode().translate(ASCII_LOWER).split()
    known = {w: xxhash.xxh64_intdigest(w) for w in set(words)}
    features = np.fromiter(known.values(), np.uint64, len(known))
    prints = np.zeros(trees, np.uint64)
    for tree in range(trees):
        ones = np.zeros(64, np.int64)
        for at in range(0, len(features), _AT_ONCE):
            bits = _mixed(features[at: at + _AT_ONCE], tree).astype(">u8").view(np.uint8)
            ones += np.unpackbits(bits).reshape(-1, 64).sum(axis=0, dtype=np.int64)
        majority = int.from_bytes(np.packbits(2 * ones > len(features)).tobytes(), "big")
        prints[tree] = (majority >> TAG) | (tree << (64 - TAG))
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(shingle, len(words))
    rolled = np.zeros(len(words) - size + 1 if size else 0, np.uint64)
    for i in range(size):
        rolled = rolled * np.uint64(_GOLDEN) + hashes[i: i + len(rolled)]
    shingles = np.unique((_mixed(rolled, size) >> np.uint64(32)).astype(np.uint32))
    return xxhash.xxh3_128_digest(b" ".join(words)), prints.view(np.int64), shingles


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, fps, shingles) for every row, with the number of shingles (n) and their parity (``BITS``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, text_col):
            keys, prints, shingles = zip(*(sketch(t) for t in texts))
            yield pa.RecordBatch.from_arrays(
                [rows.column(id_col), pa.array(keys, pa.binary()), pa.array(prints, pa.list_(pa.int64())),
                 pa.array([s.tobytes() for s in shingles], pa.binary()), pa.array([len(s) for s in shingles], pa.int64()),
                 *(pa.array(c) for c in np.stack([parity(s) for s in shingles], axis=1))],
                [id_col, "key", "fps", "shingles", "n", *BITS])

    bits = ", ".join(f"{c} long" for c in BITS)
    return docs.select(id_col, text_col).mapInArrow(
        run, schema_with(docs, [id_col], f"key binary, fps array<long>, shingles binary, n long, {bits}"))


def rare_shingles(texts: DataFrame, least: float = SIMILARITY, short: int = SHORT) -> DataFrame:
    """(key, fp) with the rarest shingles of short texts, as numbers below zero.

    Two texts as similar as ``least`` share one of the first n - ceil(least * n) + 1 in
    any common order. A partner of a short text may be longer by 1 / ``least``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.frombuffer(v.as_buffer(), np.uint32) for v in batch.column("shingles")]
            sizes = np.array([len(x) for x in lists], np.int64)
            if sizes.sum():
                every = -np.concatenate(lists).astype(np.int64) - 1
                key = batch.column("key").take(pa.array(np.repeat(np.arange(len(lists)), sizes)))
                yield pa.RecordBatch.from_arrays(
                    [key, pa.array(every), pa.array(np.repeat(sizes, sizes))], ["key", "fp", "n"])

    some = texts.filter(F.length("shingles") <= int(short / least) * 4).select("key", "shingles")
    every = stored(some.mapInArrow(run, "key binary, fp long, n long"), "shingles").withColumn("salt", salt_of("key"))
    counted = attach(every, ["fp"], "salt", {"c": F.count("*")}, {"df": F.sum("c")})
    place = F.row_number().over(Window.partitionBy("key").orderBy("df", "fp"))
    return counted.withColumn("place", place).filter(
        F.col("place") <= F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1).select("key", "fp")


def _classes(members: DataFrame) -> DataFrame:
    """(fp, class, head, m) of every fingerprint: the least one with the same texts, its first text and their number.

    Texts alike in all their words have all their fingerprints in common, and a text that shares none has each for itself:
    what is told of one of these fingerprints is told of all. Sets of texts are told apart by 128 bits, as texts are.
    """
    sets = members.groupBy("fp").agg(
        F.min("key").alias("head"), F.count("*").alias("m"), F.bit_xor(F.xxhash64("key")).alias("x"),
        F.bit_xor(F.xxhash64("key", F.lit("second"))).alias("y"))
    return sets.select("fp", F.min("fp").over(Window.partitionBy("head", "m", "x", "y")).alias("class"), "head", "m")


def candidates(texts: DataFrame, budget: int = BUDGET, leaf: int = LEAF) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(a, b), keys of texts to be judged first, a < b; (key, fp), what texts have in common; (a, b, ma, mb), stored, what
    fingerprints have texts left to meet, within one (a = b) or across a link, with the number of their texts.

    Texts with one fingerprint or rare shingle in common meet the first of them, which
    stands for them in the links of that fingerprint. Of fingerprints with the same texts one stands for all.
    """
    prints = texts.select("key", F.explode("fps").alias("fp"))
    every = stored(prints.unionByName(rare_shingles(texts)), "every")
    classes = stored(_classes(every), "classes")
    found = trie_links(classes.filter("fp >= 0").select("fp"), budget, leaf, TAG)
    for end in "ab":
        of = F.struct("class", "head", "m").alias(f"{end}of")
        found = found.join(classes.select(F.col("fp").alias(end), of), end)
    found = found.filter("aof.class <> bof.class").select(F.least("aof", "bof").alias("x"), F.greatest("aof", "bof").alias("y"))
    links = stored(found.distinct(), "links")
    own = classes.filter("fp = class")
    members = stored(every.join(own.select("fp"), "fp", "left_semi").select("key", "fp"), "members")
    drop_stored(every)
    stars = attach(members.withColumn("salt", salt_of("key")), ["fp"], "salt", {"h": F.min("key")}, {"head": F.min("h")})
    near = stars.select(F.col("head").alias("x"), F.col("key").alias("y")).unionByName(
        links.select(F.col("x.head").alias("x"), F.col("y.head").alias("y")))
    pairs = near.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    across = links.select(F.col("x.class").alias("a"), F.col("y.class").alias("b"), F.col("x.m").alias("ma"), F.col("y.m").alias("mb"))
    within = own.filter("m > 2").select(F.col("fp").alias("a"), F.col("fp").alias("b"), F.col("m").alias("ma"), F.col("m").alias("mb"))
    return pairs, members, stored(across.filter("ma + mb > 2").unionByName(within), "left")


def _fit(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and parities allow the similarity."""
    for end in "ab":
        pairs = pairs.join(_prefixed(texts, end).withColumnRenamed(f"{end}key", end), end)
    return pairs.filter(_plausible(PERCENT)).select("a", "b")


def _rest(members: DataFrame, left: DataFrame, roots: DataFrame, texts: DataFrame, heads: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b), stored, of unconnected texts within a fingerprint, or of linked ones, that its first text stood for.

    Some ``heads`` texts of each fingerprint meet all. The second table is what of ``left``, which is deleted, has texts
    that did not meet. A fingerprint of no more than ``heads`` texts is done with, and so are those whose texts are connected.
    """
    used = left.select(F.explode(F.array("a", "b")).alias("fp")).distinct()
    own = stored(members.join(used, "fp", "left_semi").join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn(
        "root", F.coalesce("root", "key")).join(texts.select("key", "n", *BITS), "key"), "rooted")
    groups = stored(own.groupBy("fp").agg(F.min("root").alias("low"), F.max("root").alias("high")), "groups")
    one, two = (groups.select(F.col("fp").alias(x), *(F.col(c).alias(c + x) for c in ("low", "high"))) for x in "ab")
    # The smaller one comes first: where all of its texts are heads, they meet all of the other's.
    first = F.col("ma") <= F.col("mb")
    pick = lambda x, y: F.when(first, F.col(x)).otherwise(F.col(y)).alias(x)
    open_ = stored(left.join(one, "a").join(two, "b").filter("least(lowa, lowb) <> greatest(higha, highb)").select(
        pick("a", "b"), pick("b", "a"), pick("ma", "mb"), pick("mb", "ma")), "open")
    more = stored(open_.filter(F.col("ma") > heads), "left")
    turned = more.filter("a <> b").select(
        F.col("b").alias("a"), F.col("a").alias("b"), F.col("mb").alias("ma"), F.col("ma").alias("mb"))
    meet = open_.unionByName(turned)
    # A head meets the texts of a large fingerprint in as many places as they are dealt to.
    sizes = meet.groupBy("a").agg(F.first("ma").alias("ma")).withColumnRenamed("a", "fp")
    some = own.join(sizes, "fp").filter(F.pmod(F.xxhash64("key"), F.ceil(F.col("ma") / heads)) == 0)
    head = meet.drop("ma").join(_prefixed(some, "a", "root", "fp").withColumnRenamed("afp", "a"), "a").withColumn(
        "side", F.explode(F.sequence(F.lit(0), F.ceil(F.col("mb") / SIDE).cast("int") - 1)))
    sides = meet.groupBy("b").agg(F.ceil(F.first("mb") / SIDE).cast("int").alias("sides")).withColumnRenamed("b", "fp")
    other = _prefixed(own.join(sides, "fp").withColumn("side", F.pmod(F.xxhash64("key"), F.col("sides")).cast("int")),
                      "b", "root", "fp", "side").withColumnRenamed("bfp", "b").withColumnRenamed("bside", "side")
    pairs = head.join(other, ["b", "side"]).filter((F.col("aroot") != F.col("broot")) & _plausible(PERCENT))
    found = stored(pairs.select(F.least("akey", "bkey").alias("a"), F.greatest("akey", "bkey").alias("b")).distinct(), "proposed")
    drop_stored(own, groups, open_, left)
    return found, more


def _beside(pairs: DataFrame, lists: DataFrame, end: str, other: str, name: str) -> DataFrame:
    """``pairs`` with the shingles of one end; those of a text in many pairs come in several copies."""
    parts = stored(pairs.groupBy(end).agg(F.ceil(F.count("*") / SHARE).cast("int").alias("_parts")), "parts")
    few = parts.limit(FEW + 1).count() <= FEW  # then only the lists that are asked for are moved
    table = lists.join(F.broadcast(parts) if few else parts, F.col("key") == F.col(end)).groupBy("key", "_parts").agg(
        F.first("shingles").alias(name)).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    dealt = pairs.join(parts, end).withColumn("_own", F.pmod(F.xxhash64(other), "_parts").cast("int"))
    return dealt.drop("_parts").join(
        table.drop("_parts"), (F.col(end) == F.col("key")) & (F.col("_own") == F.col("_part"))).drop("key", "_own", "_part")


def similar(pairs: DataFrame, lists: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose shared shingles are at least the share ``least`` of all of theirs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for one, two in zip(batch.column("one"), batch.column("two")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint32) for v in (one, two))
                small, large = sorted((len(x), len(y)))
                if small < least * large:
                    near.append(False)
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                near.append(both >= least * (small + large - both))
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    known = _beside(_beside(pairs, lists, "a", "b", "one"), lists, "b", "a", "two")
    return known.select("a", "b", "one", "two").mapInArrow(run, "a binary, b binary")


State = tuple[DataFrame, DataFrame, DataFrame]


def connections(pairs: DataFrame, lists: DataFrame, state: State | None = None) -> State:
    """(node, root) over the similar ones among ``pairs`` and those of a state, all of these, and all pairs judged.

    Each round judges every text against its partners with most pairs; pairs whose texts
    are connected by then need no judgement, so a large group costs about a star.
    """
    roots, good, judged = state or (None, None, None)
    if judged is not None:
        pairs = pairs.join(judged, ["a", "b"], "left_anti")
    todo, fan = stored(pairs, "pairs"), FAN
    if roots is not None and todo.isEmpty():
        return roots, good, judged
    while True:
        ends = todo.unionByName(todo.select(F.col("b").alias("a"), F.col("a").alias("b")))
        degrees = ends.groupBy("a").agg(F.count("*").alias("n")).withColumnRenamed("a", "b")
        order = Window.partitionBy("a").orderBy(F.desc("n"), "b")
        first = ends.join(degrees, "b").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= fan)
        batch = stored(first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "batch")
        near = stored(similar(batch, lists), "near")
        judged = batch if judged is None else judged.unionByName(batch)
        if good is None or not near.isEmpty():
            before, good = roots, near if good is None else good.unionByName(near)
            roots = components(good)
            if before is not None:
                drop_stored(before)
        rest = todo.join(batch, ["a", "b"], "left_anti")
        for end in ("a", "b"):
            own = roots.select(F.col("node").alias(end), F.col("root").alias(f"r{end}"))
            rest = rest.join(own, end, "left").withColumn(f"r{end}", F.coalesce(f"r{end}", end))
        before, todo = todo, stored(rest.filter("ra <> rb").select("a", "b"), "pairs")
        drop_stored(before)
        if todo.isEmpty():
            return roots, good, judged
        fan *= GROWTH


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, component_id) for every row; ``component_id`` is the smallest id of its near copies' group.

    Texts with the same words in the same order are near copies, so are NULL texts and
    those without words. A NULL id is never the smallest (a group of none else has NULL).
    Rows given more than once each get their row. An empty table gives no rows.
    """
    rows = stored(sketches(docs, id_col, text_col).withColumnRenamed(id_col, "id"), "sketches")
    texts = stored(rows.groupBy("key").agg(F.min("id").alias("least"), F.first("fps").alias("fps"), F.first(
        F.when(F.length("shingles") <= int(SHORT / SIMILARITY) * 4, F.col("shingles"))).alias("shingles"),
        *(F.min(c).alias(c) for c in ("n", *BITS))), "texts")  # equal for equal keys
    lists = rows.select("key", "shingles")
    pairs, members, left = candidates(texts)
    state = connections(_fit(pairs, texts), lists)
    heads = FAN
    while not left.isEmpty():
        pairs, left = _rest(members, left, state[0], texts, heads)
        state = connections(pairs, lists, state)
        heads *= GROWTH
    roots = state[0]
    owned = stored(texts.join(roots, texts.key == roots.node, "left").select(
        "key", "least", F.coalesce("root", "key").alias("root")), "owned")
    least = owned.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = owned.join(least, "root").select("key", "component_id")
    return rows.select("id", "key").join(classes, "key").select(F.col("id").alias(id_col), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their group; rows with a NULL id stay."""
    name = unused("_gone", docs)
    gone = near_copies(docs, id_col, text_col).filter(F.col("component_id") < F.col(id_col)).select(
        F.col(id_col).alias(name)).distinct()
    return docs.join(gone, F.col(id_col) == F.col(name), "left_anti")
