"""Exact and near dedup against brute force, on small tables made for the edge cases."""

from __future__ import annotations

import itertools
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tidemark.llm import components, exact_dedup, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

TEXTS = [
    (1, "one two three four five six"), (2, "one two\tthree four  five six"), (3, None), (4, ""), (5, " \n"),
    (6, "ONE two three four five six"), (7, "word"), (8, "word again"), (9, "é" * 10), (10, "x" * 50_000),
    (11, "x" * 50_000), (12, "onetwothreefourfivesix"), (None, "word"), (None, None), (7, "word"), (13, "ab\x0bcd"), (14, "abcd"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in TEXTS], DOCS)


def _expected_exact():
    groups = defaultdict(list)
    for i, t in TEXTS:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((i, t or ""))
    out = []
    for rows in groups.values():
        best = min((-len(t), i is None, i or 0) for i, t in rows)
        keep = None if best[1] else best[2]
        out += [(i, keep, len(rows), (-len(t), i is None, i or 0) == best) for i, t in rows]
    return Counter(out)


@pytest.mark.parametrize("bits", [1 << 26, 1 << 15])
def test_exact_dedup(docs, bits):
    got = exact_dedup.exact_dedup(docs, bits=bits).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got) == _expected_exact()


def test_exact_dedup_hashes_only_survivors(docs):
    hashed = {r.id for r in exact_dedup.refine(docs).filter("full_hash IS NOT NULL").collect()}
    assert 9 not in hashed and 8 not in hashed  # no other text has their length
    assert {1, 2, 10, 11} <= hashed


def test_exact_dedup_is_native(docs):
    plan = plan_of(exact_dedup.exact_dedup(docs))
    assert not re.search("Python|Arrow|Pandas", plan)


def test_exact_dedup_clashing_names(spark, docs):
    more = docs.withColumn("id", F.lit(1)).withColumn("kept", F.lit("k")).withColumn("salt", F.lit(2)).withColumn("len", F.lit(0))
    got = exact_dedup.exact_dedup(more).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got) == _expected_exact()


def test_drop_copies(docs):
    got = exact_dedup.drop_copies(docs)
    assert got.columns == docs.columns
    kept = Counter(i for i, _, _, k in _expected_exact() if k)
    assert Counter(r.doc_id for r in got.collect()) == kept  # each once, repeated rows too


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert exact_dedup.exact_dedup(none).count() == 0
    assert exact_dedup.drop_copies(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.drop_near_duplicates(none).count() == 0


def _fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _classes(fingerprints, budget):
    """Smallest id and links of each row's class, from all pairs."""
    ids = defaultdict(list)
    for i, f in fingerprints:
        ids[f].append(i)
    up = {f: f for f in ids}

    def root(f):
        while up[f] != f:
            f = up[f]
        return f

    links = Counter()
    for a, b in itertools.combinations(ids, 2):
        if (a ^ b).bit_count() <= budget:
            links[a] += 1
            links[b] += 1
            up[root(a)] = root(b)
    least = {}
    for f, own in ids.items():
        known = [i for i in own if i is not None] + ([least[root(f)]] if least.get(root(f)) is not None else [])
        least[root(f)] = min(known, default=None)
    return Counter((i, f"{f:016x}", least[root(f)], links[f]) for i, f in fingerprints)


def test_near_duplicates(docs):
    got = Counter((r.doc_id, r.fingerprint, r.component_id, r.links) for r in simhash.near_duplicates(docs).collect())
    assert got == _classes([(i, _fingerprint(t)) for i, t in TEXTS], 2)


def test_long_text_is_hashed_whole():
    text = " ".join(f"w{i}" for i in range(70_000))
    hashes = np.array([xxhash.xxh64_intdigest(f"w{i} w{i + 1} w{i + 2}".encode(), 42) for i in range(69_998)], ">u8")
    ones = np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(axis=0)
    assert simhash.fingerprint(text) == int("".join("1" if 2 * o > 69_998 else "0" for o in ones), 2)


def _clustered(seed, n):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64) * np.uint64(2)
    out = {0, 1, (1 << 64) - 1}
    for _ in range(n):
        f = int(rng.choice(centres))
        for b in rng.choice(64, rng.integers(0, 4), replace=False):
            f ^= 1 << int(b)
        out.add(f)
    return sorted(out)


@pytest.mark.parametrize("leaf", [1 << 15, 64, 2])
@pytest.mark.parametrize("budget", [0, 2, 3])
def test_trie_links(spark, leaf, budget):
    values = _clustered(leaf + budget, 400)
    df = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "fp long")
    got = Counter(frozenset((r.a & (2**64 - 1), r.b & (2**64 - 1))) for r in simhash.trie_links(df, budget, leaf).collect())
    want = {frozenset(p) for p in itertools.combinations(values, 2) if (p[0] ^ p[1]).bit_count() <= budget}
    assert set(got) == want and set(got.values()) <= {1}


def test_walk_splits_large_fronts(monkeypatch):
    monkeypatch.setattr(simhash, "_FRONTIER", 50)
    values = np.array(_clustered(5, 500), np.uint64)
    got = {frozenset((int(x), int(y))) for xs, ys in simhash.walk(values, values, 0, 0, 2, True) for x, y in zip(xs, ys)}
    assert got == {frozenset(map(int, p)) for p in itertools.combinations(values, 2) if (int(p[0]) ^ int(p[1])).bit_count() <= 2}


def test_walk_takes_little_memory():
    values = np.unique(np.random.default_rng(1).integers(0, 1 << 58, 12_000, dtype=np.uint64))  # below one node at depth 6
    tracemalloc.start()
    try:
        for _ in simhash.walk(values, values, 6, 0, 3, True):
            pass
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 64_000_000


def test_components(spark):
    rng = np.random.default_rng(3)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, int(x)) for x in rng.choice(np.arange(1000, 2000), 200, replace=False)]
    rest = [(int(a), int(b)) for a, b in rng.integers(3000, 3200, (120, 2)) if a != b]
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in chain + star + rest:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    got = {r.node: r.root for r in components.components(spark.createDataFrame(chain + star + rest, "a long, b long")).collect()}
    assert got == {x: root(x) for x in up}


def test_drop_near_duplicates(docs):
    got = simhash.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    classes = _classes([(i, _fingerprint(t)) for i, t in TEXTS], 2)
    want = Counter()  # rows of different classes may share the NULL id
    for (i, _, least, _), n in classes.items():
        want[i] += n * (i is None or i == least)
    assert Counter(r.doc_id for r in got.collect()) == +want
