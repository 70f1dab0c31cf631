"""The n-gram Jaccard join against comparing all pairs of sets."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, jaccard as jc
from tidemark.llm.common import stored


def _set(text, size=jc.SHINGLE):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i: i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def _links(sets, percent=jc.PERCENT):
    ids = sorted(sets)
    for n, j in enumerate(ids):
        for i in ids[:n]:
            x, y = sets[i], sets[j]
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)) and 100 * len(x & y) >= percent * len(x | y):
                yield i, j


def _expected(rows, percent=jc.PERCENT):
    """{place of the row: (size, smallest id of its component)}."""
    sets = {k: _set(text) for k, (_, text) in enumerate(rows)}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, j in _links(sets, percent):
        root[find(j)] = find(i)
    least = {}
    for k, (own, _) in enumerate(rows):
        if own is not None:
            least[find(k)] = min(least.get(find(k), own), own)
    return sorted(((own, len(sets[k]), least.get(find(k))) for k, (own, _) in enumerate(rows)), key=repr)


def _family(rng, size, copies, most, vocabulary):
    base = rng.choices(vocabulary, k=size)
    for _ in range(copies):
        own = list(base)
        for _ in range(rng.randrange(most + 1)):
            at = rng.randrange(len(own))
            own[at:at + 1] = rng.choice([[rng.choice(vocabulary)], [], [own[at], rng.choice(vocabulary)]])
        yield " ".join(own)


def _corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3_000)]
    texts = []
    for size, copies, most in [(8, 6, 1), (11, 8, 1), (13, 8, 1), (20, 8, 1), (30, 8, 1), (60, 12, 3), (61, 12, 2), (200, 30, 6), (900, 6, 20)]:
        for _ in range(4):
            texts += _family(rng, size, copies, most, vocabulary)
    few = ["a", "b", "c"]
    texts += [" ".join(rng.choices(few, k=rng.randrange(0, 18))) for _ in range(120)]
    passage = " ".join(rng.choices(vocabulary, k=60))
    texts += [passage + " " + " ".join(rng.choices(vocabulary, k=rng.randrange(12))) for _ in range(40)]
    rng.shuffle(texts)
    return list(enumerate(texts))


def _got(spark, rows, **how):
    found = jc.joined(spark.createDataFrame(rows, "doc_id long, text string"), **how)
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("seed, how", [(1, {}), (2, {"fragment": 16}), (3, {"percent": 80})])
def test_against_all_pairs(spark, seed, how):
    rows = _corpus(seed)
    assert _got(spark, rows, **how) == _expected(rows, how.get("percent", jc.PERCENT))


def test_linked_sets_share_a_print():
    rng = random.Random(4)
    for n in [9, 10, 11, 12, 13, 14, 19, 20, 28, 29, 42, 43, 63, 64, 95, 400]:
        for _ in range(150):
            one = np.array(rng.sample(range(1 << 62), n), np.uint64)
            most = jc.differing(2 * n)
            gone, new = rng.randrange(most + 1), 0
            while 100 * (n - gone) >= 90 * (n + new + 1) and rng.random() < 0.7:
                new += 1
            if 100 * (n - gone) < 90 * (n + new):
                gone, new = 0, max(0, (10 * n) // 90)
            two = np.concatenate([one[gone:], np.array(rng.sample(range(1 << 62, 1 << 63), new), np.uint64)])
            x, y = (np.unique(jc._mixed(s, 5)) for s in (one, two))
            assert 100 * (n - gone) >= 90 * (n + new)
            assert (gone == 0 and new == 0) or set(jc.prints(x)) & set(jc.prints(y))
            apart = np.bitwise_count((jc.parity(x) ^ jc.parity(y)).view(np.uint64)).sum()
            assert apart <= gone + new


def test_rounds_find_links_beside_the_head(spark, monkeypatch):
    """Texts of one print that do not link with its first text do so with each other."""
    monkeypatch.setattr(jc, "HEADS", 1)
    monkeypatch.setattr(jc, "FAN", 1)
    monkeypatch.setattr(jc, "MORE", 2)
    rng = random.Random(6)
    words = [f"v{i}" for i in range(500)]
    rows = []
    for _ in range(3):
        base = rng.choices(words, k=40)
        for i in range(12):  # each a word further from the first
            base = list(base)
            base[(3 * i) % 40] = rng.choice(words)
            rows.append((len(rows), " ".join(base)))
    assert _got(spark, rows) == _expected(rows)
    assert _got(spark, rows, percent=75) == _expected(rows, 75)


def test_pairs_are_few_in_a_large_group(spark):
    rng = random.Random(8)
    texts = list(_family(rng, 150, 300, 2, [f"w{i}" for i in range(2_000)]))
    rows = jc.sketches(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text", jc.SHINGLE, jc.PERCENT)
    members = jc.shared_prints(rows)
    different = rows.select("key").distinct().count()
    assert jc._star(members, rows.dropDuplicates(["key"]), jc.PERCENT).count() < 12 * different < different * (different - 1) / 4


def test_members_of_connected_prints_are_left_out_of_later_rounds(spark):
    members = stored(spark.createDataFrame(
        [(1, b"a"), (1, b"b"), (1, b"c"), (2, b"d"), (2, b"e"), (2, b"f"), (3, b"a"), (3, b"d")], "print long, key binary"), "members")
    roots = spark.createDataFrame([(b"a", b"a"), (b"b", b"a"), (b"c", b"a"), (b"d", b"d"), (b"e", b"d")], "node binary, root binary")
    sets = spark.createDataFrame(
        [(bytes([k]), k, 9, *[0] * len(jc.BITS)) for k in b"abcdef"], f"key binary, id long, n long, {', '.join(f'{c} long' for c in jc.BITS)}")
    pairs, most, left = jc._rest(members, roots, sets, 8, jc.PERCENT)
    assert most == 3 and sorted((r.print, bytes(r.key)) for r in left.collect()) == [(2, b"d"), (2, b"e"), (2, b"f")]
    assert {(bytes(r.a), bytes(r.b)) for r in pairs.collect()} == {(b"d", b"f"), (b"e", b"f")}


def test_stored_tables_leave_no_shuffle_files(spark):
    def shuffled():
        return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").count("shuffle_")

    before, setting = shuffled(), spark.conf.get(common._CLEANUP, None)
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    assert sorted(stored(df, "counts").collect()) == sorted(stored(df, "counts").collect())
    assert shuffled() <= before and spark.conf.get(common._CLEANUP, None) == setting


def test_nulls_repeats_empty_and_other_columns(spark):
    rows = [(None, "a b c d"), (3, "a b c d"), (3, "A  b\tc d"), (2, None), (4, ""), (5, " \n"), (None, None), (7, "x"), (8, "X"), (None, "only one here")]
    assert _got(spark, rows) == _expected(rows)
    assert _got(spark, []) == []
    with pytest.raises(ValueError):
        _got(spark, [], percent=60)
    names = ["id", "key", "n", "code", "prints", "p0", "akey", "bn", "place", "slot", "page", "bitmap", "survives", "salt", "head", "component_id", "root", "node"]
    clash = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", "text", *(F.lit("?").alias(c) for c in names))
    assert sorted((tuple(r) for r in jc.joined(clash).collect()), key=repr) == _expected(rows)


def test_query_against_all_pairs(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in jc.op11_jaccard_join(spark, sf).collect()), key=repr) == _expected(rows)
