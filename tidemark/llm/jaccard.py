"""N-gram Jaccard join by vertical partitioning.

The order of all n-grams, that of their hashes, is cut into fragments, and so is each
document's set. Two sets that are similar enough differ in at most so many n-grams, a
number that follows from their sizes; cut into one fragment more than that, they agree in
one fragment at least. So documents that have no fragment in common with another are done
with, and the others form pairs. A pair's sets are then cut into few, bounded fragments:
the overlap of each fragment is counted on its own, and the counts are summed per pair.

Equal sets are one class and never paired. The classes of a fragment are first paired
with one of them, and with each other in later rounds as far as they are not connected by
then; of the pairs proposed each class is counted with a few at a time. So a large group
of near copies costs about a star, and a link between classes that have no other way to
each other is never left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import ASCII_LOWER, attach, drop_stored, salt_of, schema_with, stored, text_slices
from tidemark.llm.components import components
from tidemark.llm.exact_dedup import FILTER_BITS, _marked, _slot, _with_survival

#: Words of a shingle; sets link at this share of their union (a per cent).
SHINGLE, PERCENT = 3, 90

#: The largest size of the first level, whose sets must be equal to link, and the growth of a level.
FIRST, GROWTH = 9, 1.5

#: Times that a set with an empty fragment is cut anew before empty fragments count as equal.
CUTS = 3

#: Bits that hold for each set which of as many classes of n-grams it has an odd number of, as longs.
PARITY = 512
BITS = [f"p{i}" for i in range(PARITY // 64)]

#: Bits of a print that are compared before the prints themselves.
KNOWN = 40

#: N-grams of a fragment that are counted at a time.
FRAGMENT = 4096

#: Classes that all others of a fragment are paired with in a later round, partners that a class is counted with
#: at a time, and how both grow.
HEADS, FAN, MORE = 8, 8, 16

#: Rows of a table that is broadcast after they were counted (32 bytes each).
FEW = 200_000

_GOLDEN = 0x9E3779B97F4A7C15
_WORD = 1 << 64


def _mixed(hashes: np.ndarray, seed: int) -> np.ndarray:
    """Other hashes for another seed."""
    x = hashes ^ np.uint64(_GOLDEN * (seed + 1) % _WORD)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """The hashes of a text's different shingles, in order; one of all its words where they are fewer, none without words."""
    words = text.encode().translate(ASCII_LOWER).split()
    known = {w: xxhash.xxh64_intdigest(w) for w in set(words)}
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(shingle, len(words))
    rolled = np.zeros(len(words) - size + 1 if size else 0, np.uint64)
    for i in range(size):
        rolled = rolled * np.uint64(_GOLDEN) + hashes[i: i + len(rolled)]
    return np.unique(_mixed(rolled, size))


def differing(sizes: int, percent: int = PERCENT) -> int:
    """N-grams in which two sets with ``sizes`` in all may differ and still link."""
    return sizes * (100 - percent) // (100 + percent)


@lru_cache(None)
def levels(n: int, percent: int = PERCENT) -> tuple[int, ...]:
    """The largest sizes of the levels in which sets of size ``n`` are met: its own, the next one if a partner may be there."""
    top = FIRST
    while top < n:
        top = int(top * GROWTH)
    return (top, int(top * GROWTH)) if 100 * n >= percent * (top + 1) else (top,)


@lru_cache(None)
def _cuts(parts: int) -> np.ndarray:
    return np.array([-(-i * _WORD // parts) for i in range(1, parts)], np.uint64)


def _edges(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Where each of ``parts`` fragments of a set begins, and the end."""
    return np.concatenate([[0], np.searchsorted(hashes, _cuts(parts)), [len(hashes)]])


def prints(hashes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """A number for each fragment of a set at its levels; linked sets of different content have one in common."""
    out = []
    for top in levels(len(hashes), percent):
        parts = differing(2 * top, percent) + 1
        if parts == 1:
            continue
        own = hashes
        for cut in range(CUTS):
            edges = _edges(own, parts)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(own, 101))])
            names = _mixed(np.arange(parts, dtype=np.uint64), top * CUTS + cut)
            full = np.diff(edges) > 0
            last = cut == CUTS - 1
            found = _mixed(sums[edges[1:]] - sums[edges[:-1]], 103) + names
            out.append(found if last else found[full])
            if last or full.all():
                break
            own = np.sort(_mixed(hashes, 107 + cut))
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def parity(hashes: np.ndarray) -> np.ndarray:
    """Bits of which two sets differ in no more than they differ in n-grams."""
    odd = np.bincount((hashes & np.uint64(PARITY - 1)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sketches(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """(id, n, key, code, prints, parity) for every row; key tells sets apart, code is a part of it, NULL without words.

    The parity is in the columns ``BITS``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, "text"):
            sets = [shingle_set(t, shingle) for t in texts]
            keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()),
                 pa.array([k and int.from_bytes(k[:8], "big", signed=True) for k in keys], pa.int64()),
                 pa.array([prints(s, percent) for s in sets], pa.list_(pa.int64())),
                 *(pa.array(c) for c in np.stack([parity(s) for s in sets], axis=1))],
                ["id", "n", "key", "code", "prints", *BITS])

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(run, schema_with(
        plain, ["id"], "n long, key binary, code long, prints array<long>, " + ", ".join(f"{c} long" for c in BITS)))


def shared_prints(rows: DataFrame) -> DataFrame:
    """(print, key), without repeats, for the prints that different sets have.

    A bitmap of fixed size carries them to the sets, so that all others need no shuffle with their keys. It is made
    from the upper ``KNOWN`` bits of the prints: a few more may pass, none is lost, and zeros take little room in a shuffle.
    """
    known = F.col("print").bitwiseAND(F.lit(-(1 << 64 - KNOWN)))
    slot = _slot(known, bits=FILTER_BITS)
    every = rows.select("code", F.explode("prints").alias("print")).select("code", known.alias("print"))
    several = every.groupBy("print").agg(F.min("code").alias("low"), F.max("code").alias("high")).filter("low <> high")
    pages = stored(_marked(several.select(slot.alias("slot")), FILTER_BITS), "prints")
    kept = _with_survival(rows.select("key", F.explode("prints").alias("print")), slot, pages).filter("survives")
    some = stored(kept.select("print", "key").distinct(), "some")
    ends = some.groupBy("print").agg(F.min("key").alias("low"), F.max("key").alias("high")).filter("low <> high")
    members = stored(some.join(ends, "print", "left_semi"), "members")
    drop_stored(some, pages)
    return members


def _only(table: DataFrame, keys: DataFrame, label: str) -> DataFrame:
    """The rows of ``table`` whose key is among ``keys``, stored; these are broadcast where they were counted to be few."""
    keys = stored(keys.select("key").distinct(), "keys")
    few = keys.limit(FEW + 1).count() <= FEW
    found = stored(table.join(F.broadcast(keys) if few else keys, "key", "left_semi"), label)
    drop_stored(keys)
    return found


def fragments(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, shingle: int, percent: int,
              fragment: int) -> DataFrame:
    """(key, parts, part, grams) of the sets in ``wanted`` (id, key): cut into fragments of ``fragment`` n-grams or so.

    The texts are read again, for most sets are not wanted. A set is cut for each of its levels, as its partners are,
    and comes as often as its text does with one of the ids.
    """
    slot = _slot(F.col("id"), bits=FILTER_BITS)
    pages = stored(_marked(wanted.select(slot.alias("slot")).distinct(), FILTER_BITS), "wanted")
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_slices(batches, "text"):
            out = []
            for text in texts:
                own = shingle_set(text, shingle)
                key = xxhash.xxh3_128_digest(own.tobytes())
                for parts in {parts_of(top, fragment) for top in levels(len(own), percent)}:
                    edges = _edges(own, parts).tolist()
                    out += [(key, parts, i, own[a:b].tobytes()) for i, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
            if out:
                kinds = [pa.binary(), pa.int32(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["key", "parts", "part", "grams"])

    some = _with_survival(plain, slot, pages).filter("survives").select("id", "text")
    found = _only(some.mapInArrow(run, "key binary, parts int, part int, grams binary"), wanted, "grams")
    drop_stored(pages)
    return found


def parts_of(top: int, fragment: int = FRAGMENT) -> int:
    return -(-top // fragment)


def _plausible(percent: int, one: str = "a", two: str = "b") -> Column:
    """Whether sizes (n) and parities of two sets, told by a prefix of their columns, allow a link."""
    n, m = F.col(f"{one}n"), F.col(f"{two}n")
    apart = sum((F.bit_count(F.col(one + c).bitwiseXOR(F.col(two + c))) for c in BITS), F.lit(0))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (apart * (100 + percent) <= (n + m) * (100 - percent))


def _prefixed(sets: DataFrame, prefix: str, *more: str) -> DataFrame:
    return sets.select(*(F.col(c).alias(prefix + c) for c in ("key", "n", *BITS, *more)))


def _ordered(pairs: DataFrame) -> DataFrame:
    """(a, b, na, nb), the smaller key first, each pair once."""
    first = F.col("akey") < F.col("bkey")
    pick = lambda x, y, c: F.when(first, F.col(x + c)).otherwise(F.col(y + c))
    return pairs.select(pick("a", "b", "key").alias("a"), pick("b", "a", "key").alias("b"),
                        pick("a", "b", "n").alias("na"), pick("b", "a", "n").alias("nb")).distinct()


def linked(pairs: DataFrame, grams: DataFrame, percent: int = PERCENT, fragment: int = FRAGMENT) -> DataFrame:
    """(a, b), stored: the pairs (a, b, na, nb) that link; overlaps are counted in each fragment and summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = []
            for one, two in zip(batch.column("one"), batch.column("two")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (one, two))
                both.append(len(x) + len(y) - len(np.union1d(x, y)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("a", "b", "na", "nb", "part")), pa.array(both, pa.int64())],
                ["a", "b", "na", "nb", "part", "both"])

    # The level of the larger set, as levels() has it: both sets are cut for it.
    top, tops = FIRST, [FIRST]
    while top < 1 << 40:
        top = int(top * GROWTH)
        tops.append(top)
    level = F.aggregate(F.array(*(F.lit(t).cast("long") for t in reversed(tops))), F.lit(tops[-1]).cast("long"),
                        lambda best, t: F.when(t >= F.greatest("na", "nb"), t).otherwise(best))
    cut = pairs.withColumn("parts", F.ceil(level / fragment).cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    ends = stored(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "keys")
    few = ends.limit(FEW + 1).count() <= FEW  # then the n-grams of the pairs' sets are picked out while they are read
    asked = grams.join(F.broadcast(ends), "key", "left_semi") if few else stored(grams.join(ends, "key", "left_semi"), "asked")
    # A head stands in many pairs, at the end "a" for the most part: the other end's n-grams move with the pairs.
    for end, name in (("b", "two"), ("a", "one")):
        cut = cut.join(asked.select(F.col("key").alias(end), "parts", "part", F.col("grams").alias(name)), [end, "parts", "part"])
    counts = cut.select("a", "b", "na", "nb", "part", "one", "two").mapInArrow(
        run, "a binary, b binary, na long, nb long, part int, both long")
    once = counts.groupBy("a", "b", "na", "nb", "part").agg(F.max("both").alias("both"))  # a text may come twice
    total = once.groupBy("a", "b", "na", "nb").agg(F.sum("both").alias("both"))
    good = total.filter(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both")))
    links = stored(good.select("a", "b"), "links")
    drop_stored(ends, *([] if few else [asked]))
    return links


def _star(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, na, nb): the classes of each print with the first of them, where they may link."""
    own = attach(members.withColumn("salt", salt_of("key")), ["print"], "salt", {"h": F.min("key")}, {"head": F.min("h")})
    pairs = own.filter("head <> key").select(F.col("head").alias("akey"), F.col("key").alias("bkey")).distinct()
    for prefix in "ba":
        pairs = pairs.join(_prefixed(sets, prefix), f"{prefix}key")
    return _ordered(pairs.filter(_plausible(percent)))


def _rest(members: DataFrame, roots: DataFrame, sets: DataFrame, heads: int,
          percent: int) -> tuple[DataFrame, int, DataFrame]:
    """(a, b, na, nb), stored, of classes of a print that are not connected and may link, for ``heads`` of them or so.

    The number is the most classes of such a print. The last are the ``members`` of such prints, stored: all others
    are done with, for classes that are connected stay so. ``members`` is deleted.
    """
    own = members.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    own = stored(own, "rooted")
    groups = own.groupBy("print").agg(
        F.count("*").alias("members"), F.min("root").alias("low"), F.max("root").alias("high")).filter("members > 2 AND low <> high")
    groups = stored(groups.select("print", "members"), "open")
    most = groups.agg(F.max("members")).first()[0] or 0
    left = stored(own.join(groups, "print"), "members")
    drop_stored(own, groups, members)
    some = left.join(sets.drop("id"), "key")
    first = some.filter(F.pmod(F.xxhash64("key"), F.ceil(F.col("members") / heads)) == 0)
    pairs = _prefixed(first, "a", "print", "root").join(
        _prefixed(some, "b", "print", "root"),
        (F.col("aprint") == F.col("bprint")) & (F.col("aroot") != F.col("broot")) & _plausible(percent))
    return stored(_ordered(pairs), "proposed"), most, left.select("print", "key")


State = tuple[DataFrame, DataFrame, DataFrame]


def _connected(todo: DataFrame, state: State | None, grams: DataFrame, percent: int, fragment: int) -> State:
    """(components, links, counted pairs) after ``todo``: each class is counted with the first few of its partners,
    then pairs that are connected are passed over, until none is left."""
    roots, good, judged = state or (None, None, None)
    if judged is not None:
        todo = todo.join(judged, ["a", "b"], "left_anti")
    todo, fan = stored(todo, "pairs"), FAN
    if roots is not None and todo.isEmpty():
        return roots, good, judged
    while True:
        ends = todo.unionByName(todo.select(F.col("b").alias("a"), F.col("a").alias("b"), "na", "nb"))
        place = F.row_number().over(Window.partitionBy("a").orderBy("b"))
        some = ends.withColumn("place", place).filter(F.col("place") <= fan).select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        batch = stored(todo.join(some, ["a", "b"], "left_semi"), "batch")
        links = linked(batch, grams, percent, fragment)
        judged = batch.select("a", "b") if judged is None else judged.unionByName(batch.select("a", "b"))
        if good is None or not links.isEmpty():
            before, good = roots, links if good is None else good.unionByName(links)
            roots = components(good)
            if before is not None:
                drop_stored(before)
        rest = todo.join(batch, ["a", "b"], "left_anti")
        for end in "ab":
            own = roots.select(F.col("node").alias(end), F.col("root").alias(f"r{end}"))
            rest = rest.join(own, end, "left").withColumn(f"r{end}", F.coalesce(f"r{end}", end))
        before, todo = todo, stored(rest.filter("ra <> rb").select("a", "b", "na", "nb"), "pairs")
        drop_stored(before)
        if todo.isEmpty():
            return roots, good, judged
        fan *= MORE


def joined(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT,
           fragment: int = FRAGMENT) -> DataFrame:
    """(id, n_shingles, component_id) for every row; ``component_id`` is the smallest id reachable over links.

    Two texts link when their sets of shingles share ``percent`` per cent of their union or more. A NULL text or one
    without words has an empty set and links with nothing. NULL ids are never the smallest; rows given more than once
    each get their row. Texts of any length are compared whole. An empty table gives no rows. ``percent`` is 70 at least,
    for a set then meets all partners at its own level and the next.
    """
    if percent < 70:
        raise ValueError("sets that share less than 70 per cent are not joined by this method")
    whole = stored(sketches(docs, id_col, text_col, shingle, percent), "sets")
    members = shared_prints(whole.filter("n > 0"))
    rows = stored(whole.drop("prints"), "rows")  # the prints take most of the room
    drop_stored(whole)
    some = rows.filter("n > 0")
    keys = members.select("key").distinct()
    own = _only(some.select("key", "id", "n", *BITS), keys, "own")
    sets = stored(own.groupBy("key").agg(
        F.min("id").alias("id"), *(F.min(c).alias(c) for c in ("n", *BITS))), "classes")  # equal for equal keys
    drop_stored(own)
    grams = fragments(docs, sets.select("id", "key"), id_col, text_col, shingle, percent, fragment)
    state = _connected(_star(members, sets, percent), None, grams, percent, fragment)
    heads = HEADS
    while True:
        pairs, most, members = _rest(members, state[0], sets, heads, percent)
        if not most:
            break
        state = _connected(pairs, state, grams, percent, fragment)
        if heads >= most:  # each class was a head
            break
        heads *= MORE
    least = some.groupBy("key").agg(F.min("id").alias("least")).join(state[0].withColumnRenamed("node", "key"), "key")
    whole = stored(least.join(least.groupBy("root").agg(F.min("least").alias("component_id")), "root").select(
        "key", "component_id"), "components")
    # The classes ride along as rows of the same key, so that no set's copies meet in one task.
    member = some.select("id", "n", "key", F.col("id").alias("component_id"), F.lit(False).alias("head"))
    head = whole.select(F.lit(None).cast(rows.schema["id"].dataType).alias("id"), F.lit(None).cast("long").alias("n"),
                        "key", "component_id", F.lit(True).alias("head"))
    found = attach(member.unionByName(head).withColumn("salt", salt_of("id")), ["key"], "salt",
                   {"c": F.min("component_id")}, {"component_id": F.min("c")}).filter("NOT head")
    alone = rows.filter("n = 0").withColumn("component_id", F.col("id"))
    return found.select("id", "n", "component_id").unionByName(alone.select("id", "n", "component_id")).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def op11_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return joined(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM g),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id
    AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
edge AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT a, b FROM edge UNION SELECT r.a, k.b FROM reach r JOIN edge k ON r.b = k.a)
SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce((SELECT min(b) FROM reach WHERE a = doc_id), doc_id)) AS component_id
FROM g
"""
