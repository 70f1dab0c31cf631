"""Ranked lexical search: branch and bound over FP-trees of documents.

A document is restricted to the terms that some item asks for, most frequent first, so
that documents share the beginnings of their vectors. A block of documents is sorted by
these vectors, which makes every node of its trie a run of neighbours. A node keeps the
largest number of occurrences of each term below it and the smallest length factor m;
both bound the score of every document below. For each item the trie is searched depth
first, best child first, and a node whose bound cannot reach the item's list is left out.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import ASCII_LOWER, stored, text_slices

#: Results of an item.
TOP = 20

#: Documents of a block and terms of their vectors (whichever is reached first), documents of a leaf, nodes of a
#: tree (leaves are larger beyond them).
BLOCK, VECTORS, LEAF, NODES = 8192, 2_000_000, 32, 2048

#: Terms of items, repeats within an item apart: those that share a tree, and those that share a pass over the texts.
GROUP, PASS = 16_384, 262_144

#: All bytes that end a term are spaces, capital letters are small ones.
_TERMS = bytes(b if b >= 0x80 or chr(b).isascii() and chr(b).isalnum() else 32 for b in range(256)).translate(ASCII_LOWER)


def terms(text: str) -> list[bytes]:
    """The maximal runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case."""
    return text.encode().translate(_TERMS).split()


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, row, term, times): the terms of each row of ``items``; rows are numbered, for ids may repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, "text"):
            for i, text in enumerate(texts):
                if found := Counter(terms(text)):
                    one = pa.repeat(rows.column("item")[i], len(found))
                    number = pa.repeat(rows.column("row")[i], len(found))
                    yield pa.RecordBatch.from_arrays(
                        [one, number, pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())],
                        ["item", "row", "term", "times"])

    numbered = stored(items.select(F.col(id_col).alias("item"), F.col(text_col).alias("text")).withColumn(
        "row", F.monotonically_increasing_id()), "items")
    kind = numbered.schema["item"].dataType.simpleString()
    return numbered.mapInArrow(run, f"item {kind}, row long, term binary, times long")


def vectors(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(doc, n, ids, tfs) for every document with a term; ids and tfs are of the terms in ``vocabulary`` alone."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for rows, texts in text_slices(batches, "text"):
            has, lengths, sizes, ids, tfs = [], [], [], [], []
            for text in texts:
                found = terms(text)
                has.append(bool(found))
                if found:
                    own = Counter(filter(None, map(known.get, found)))
                    lengths.append(len(found))
                    sizes.append(len(own))
                    ids += own
                    tfs += own.values()
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc").filter(pa.array(has, pa.bool_())), pa.array(lengths, pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int32()))], ["doc", "n", "ids", "tfs"])

    plain = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    kind = plain.schema["doc"].dataType.simpleString()
    return plain.mapInArrow(run, f"doc {kind}, n long, ids array<int>, tfs array<int>")


def part_score(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds for each unit of its weight; grows with ``tf`` and falls with ``m``."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Tree(NamedTuple):
    """A block of documents in the order of their vectors, and the nodes of its trie in depth-first order."""

    docs: np.ndarray  # place of each document in the block as given
    m: np.ndarray
    starts: np.ndarray  # first term of each document, and the end
    ids: np.ndarray
    tfs: np.ndarray
    low: np.ndarray  # first document of each node, and the end
    high: np.ndarray
    children: list[list[int]]  # none: a leaf
    most: np.ndarray  # occurrences of each term (column) below each node (row)
    least_m: np.ndarray
    first: np.ndarray  # place by id of the document below with the smallest one


def grow(m: np.ndarray, starts: np.ndarray, ids: np.ndarray, tfs: np.ndarray, width: int, leaf: int = LEAF,
         nodes: int = NODES) -> Tree:
    """The tree of documents given in the order of their ids; ``ids`` are ranks by frequency, in order for each document.

    The largest nodes are split first, until all are leaves or there are ``nodes`` of them.
    """
    keys = ids.astype(">u4")
    paths = [keys[a:b].tobytes() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
    docs = np.array(sorted(range(len(paths)), key=paths.__getitem__), np.int64)
    sizes = np.diff(starts)[docs]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.repeat(starts[:-1][docs] - ends[:-1], sizes) + np.arange(ends[-1])
    ids, tfs, m = ids[flat], tfs[flat], m[docs]
    low: list[int] = []
    high: list[int] = []
    children: list[list[int]] = []

    def node(lo: int, hi: int) -> int:
        low.append(lo)
        high.append(hi)
        children.append([])
        return len(low) - 1

    todo = [(-len(docs), node(0, len(docs)))] if len(docs) else []
    while todo and len(low) < nodes:
        _, own = heapq.heappop(todo)
        lo, hi = low[own], high[own]
        one, two = ids[ends[lo]:ends[lo + 1]], ids[ends[hi - 1]:ends[hi]]
        both = min(len(one), len(two))
        apart = np.flatnonzero(one[:both] != two[:both])
        depth = int(apart[0]) if len(apart) else both  # the path that all documents share ends here
        if hi - lo <= leaf or depth == len(two):  # few documents, or equal vectors
            continue
        at = np.where(sizes[lo:hi] > depth, ids[np.minimum(ends[lo:hi] + depth, len(ids) - 1)], -1)
        cuts = np.flatnonzero(np.diff(at)) + 1
        edges = [lo, *(cuts + lo).tolist(), hi]
        begin = lo
        for a, b in zip(edges[:-1], edges[1:]):  # small siblings lie in one leaf
            if b - begin <= leaf:
                continue
            if a > begin:
                children[own].append(node(begin, a))
                begin = a
            if b - begin > leaf:
                children[own].append(node(begin, b))
                heapq.heappush(todo, (begin - b, children[own][-1]))
                begin = b
        if begin < hi:
            children[own].append(node(begin, hi))
    most = np.zeros((len(low), width), np.int32)
    least_m, first = np.zeros(len(low), np.int64), np.zeros(len(low), np.int64)
    for own in range(len(low) - 1, -1, -1):  # a child has a higher number than its parent
        lo, hi = low[own], high[own]
        if children[own]:
            np.max(most[children[own]], axis=0, out=most[own])
        else:
            np.maximum.at(most[own], ids[ends[lo]:ends[hi]], tfs[ends[lo]:ends[hi]])
        least_m[own], first[own] = m[lo:hi].min(), docs[lo:hi].min()
    return Tree(docs, m, ends, ids, tfs, np.array(low), np.array(high), children, most, least_m, first)


def search(tree: Tree, asked: np.ndarray, weights: np.ndarray, top: int, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of the ``top`` best of a tree, highest first, equal ones in the order given.

    ``asked`` are the item's terms and ``weights`` what each weighs, repeats included;
    documents below ``least`` are of no interest.
    """
    bounds = (part_score(tree.most[:, asked].astype(np.int64), tree.least_m[:, None]) * weights).sum(axis=1)
    by_term = np.zeros(tree.most.shape[1], np.int64)
    by_term[asked] = weights
    best, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    last = None  # the document that a further one has to come before, of equal score
    todo = [0] if len(bounds) else []
    while todo:
        own = todo.pop()
        if bounds[own] < least or bounds[own] == least and last is not None and tree.first[own] > last:
            continue
        kids = tree.children[own]
        if kids:
            todo += sorted(kids, key=bounds.__getitem__)  # the best child is looked at first
            continue
        lo, hi = tree.low[own], tree.high[own]
        begin = tree.starts[lo]
        flat = slice(begin, tree.starts[hi])
        weight = by_term[tree.ids[flat]]
        held = np.flatnonzero(weight)
        row = np.searchsorted(tree.starts[lo + 1:hi + 1] - begin, held, side="right")
        parts = weight[held] * part_score(tree.tfs[flat][held].astype(np.int64), tree.m[lo:hi][row])
        total = np.zeros(hi - lo, np.int64)
        np.add.at(total, row, parts)
        good = np.flatnonzero(total >= least)
        if not len(good):
            continue
        best = np.concatenate([best, tree.docs[lo:hi][good]])
        scores = np.concatenate([scores, total[good]])
        order = np.lexsort((best, -scores))[:top]
        best, scores = best[order], scores[order]
        if len(best) == top:
            least, last = max(least, int(scores[-1])), int(best[-1])
    return best, scores


def _by_id(doc):
    return doc is None, 0 if doc is None else doc


class Group(NamedTuple):
    """Items that share a tree: the rank of each term of the pass (-1: not asked for), and (row, ranks, weights)."""

    ranks: np.ndarray
    width: int
    items: list[tuple[int, np.ndarray, np.ndarray]]


def _searched(shared, total: int, words: int, top: int, block: int, most: int):
    """Restricted vectors as the best documents of each item among the rows of a task.

    What an item's list holds when a tree ends bounds the search of the task's next trees.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists: dict[int, tuple[np.ndarray, list]] = {}
        kind = None

        def take(held: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(held).combine_chunks()
            ids = table.column("doc").to_pylist()
            order = sorted(range(len(ids)), key=lambda i: _by_id(ids[i]))
            table = table.take(pa.array(order))
            ids = [ids[i] for i in order]
            m = 75 + 25 * table.column("n").to_numpy() * total // words
            found, tfs = (table.column(c).combine_chunks() for c in ("ids", "tfs"))
            rows = np.repeat(np.arange(len(ids)), np.diff(found.offsets.to_numpy()))
            found, tfs = found.flatten().to_numpy(), tfs.flatten().to_numpy()
            for group in shared.value:
                ranks = group.ranks[found]
                here = np.flatnonzero(ranks >= 0)
                here = here[np.lexsort((ranks[here], rows[here]))]
                starts = np.searchsorted(rows[here], np.arange(len(ids) + 1))
                tree = grow(m, starts, ranks[here], tfs[here], group.width)
                for row, asked, weights in group.items:
                    scores, docs = lists.get(row, (np.zeros(0, np.int64), []))
                    least = int(scores[-1]) if len(scores) == top else 1
                    best, own = search(tree, asked, weights, top, least)
                    if len(best):
                        docs = docs + [ids[i] for i in best.tolist()]
                        scores = np.concatenate([scores, own])
                        order = sorted(range(len(docs)), key=lambda i: (-scores[i], _by_id(docs[i])))[:top]
                        lists[row] = scores[order], [docs[i] for i in order]

        held: list[pa.RecordBatch] = []
        count = weight = 0
        for batch in batches:
            kind = batch.schema.field("doc").type
            begin = 0
            sizes = np.diff(batch.column("ids").offsets.to_numpy()).tolist()
            for i, size in enumerate(sizes):
                count, weight = count + 1, weight + size
                if count >= block or weight >= most:
                    take([*held, batch.slice(begin, i + 1 - begin)])
                    held, begin, count, weight = [], i + 1, 0, 0
            if begin < len(sizes):
                held.append(batch.slice(begin))
        if held:
            take(held)
        for row, (scores, docs) in lists.items():
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(row, pa.int64()), len(docs)), pa.array(docs, kind), pa.array(scores)],
                ["row", "doc", "score"])

    return run


def weight_of(total: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1)))


def groups_of(asked: list[tuple[int, int, int]], df: dict[int, int], total: int, words: int, size: int) -> list[Group]:
    """Items (row, term, times) with some ``size`` terms to a group; terms are ranked by the documents that hold them."""
    by_row: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for row, term, times in asked:
        if term in df:  # no document is the better for a term that none holds
            by_row[row].append((term, times))
    packs: list[list[int]] = []
    room = 0
    for row, own in by_row.items():
        if not packs or len(own) > room:
            packs.append([])
            room = size
        packs[-1].append(row)
        room -= len(own)
    out = []
    for pack in packs:
        common = sorted({t for row in pack for t, _ in by_row[row]}, key=lambda t: (-df[t], t))
        ranks = np.full(words + 1, -1, np.int32)
        ranks[common] = np.arange(len(common))
        out.append(Group(ranks, len(common), [
            (row, ranks[[t for t, _ in by_row[row]]].astype(np.int64),
             np.array([times * weight_of(total, df[t]) for t, times in by_row[row]], np.int64)) for row in pack]))
    return out


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", block: int = BLOCK, most: int = VECTORS) -> DataFrame:
    """(item, rank, doc, score): the ``top`` documents with the highest scores above 0 for every row of ``items``.

    Equal scores go by document id, NULL ids last; a document given more than once ranks each time, an item given
    more than once is answered each time. Texts that are NULL or hold no term take no part, very long ones count
    whole. An empty table gives no rows.
    """
    spark = docs.sparkSession
    asked = stored(item_terms(items, item_col, item_text), "asked")
    kinds = asked.schema["item"].dataType.simpleString(), docs.schema[id_col].dataType.simpleString()
    out = spark.createDataFrame([], f"item {kinds[0]}, rank int, doc {kinds[1]}, score long")
    passes = math.ceil(asked.count() / PASS)
    for number in range(passes):
        own = asked.filter(F.pmod(F.xxhash64("row"), F.lit(passes)) == number)
        own = own.select("row", "term", "times").collect()  # some PASS terms, however many items there are
        vocabulary = {term: i for i, term in enumerate(sorted({bytes(r.term) for r in own}), 1)}
        rows = stored(vectors(docs, vocabulary, id_col, text_col), "vectors")
        total, words = rows.agg(F.count("*"), F.sum("n")).first()
        if not total:
            break
        df = dict(rows.select(F.explode("ids").alias("id")).groupBy("id").count().collect())
        groups = groups_of([(r.row, vocabulary[bytes(r.term)], r.times) for r in own], df, total, len(vocabulary), GROUP)
        # Dealt by number, so that tasks stay alike and their number follows the documents.
        dealt = rows.select("doc", "n", "ids", "tfs").repartition(math.ceil(total / (2 * block)))
        found = dealt.mapInArrow(
            _searched(spark.sparkContext.broadcast(groups), total, words, top, block, most),
            f"row long, doc {kinds[1]}, score long")
        order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
        best = stored(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top), "best")
        out = out.unionByName(best.join(asked.select("row", "item").distinct(), "row").select("item", "rank", "doc", "score"))
    return out


def op13_lexical_search(spark, sf_dir: str) -> DataFrame:
    found = ranked(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

SQL = f"""
WITH t AS (
  SELECT r, doc_id, unnest(regexp_extract_all(translate(text, {_LOWER}), '{_TERM}')) AS term
  FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)),
d AS (SELECT r, doc_id, count(*) AS n FROM t GROUP BY r, doc_id),
s AS (SELECT count(*) AS total, CAST(sum(n) AS BIGINT) AS words FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM t GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(total) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term),
i AS (
  SELECT k, item_id, term, count(*) AS times FROM (
    SELECT k, item_id, unnest(regexp_extract_all(translate(text, {_LOWER}), '{_TERM}')) AS term
    FROM (SELECT row_number() OVER () AS k, item_id, text FROM benchmark)) GROUP BY ALL),
p AS (
  SELECT k, item_id, d.r, doc_id,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * total) // words)))) AS BIGINT) AS score
  FROM i JOIN w USING (term) JOIN tf USING (term) JOIN d ON d.r = tf.r, s GROUP BY ALL),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM p WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= {TOP}
"""
