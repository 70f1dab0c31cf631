"""Ranked lexical search against scoring every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import lexical as lx

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def _terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _expected(docs, items, top=lx.TOP):
    counts = [(doc, Counter(_terms(text))) for doc, text in docs]
    counts = [(doc, c) for doc, c in counts if c]
    total, words = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in counts:
            m = 100 - 25 + 25 * sum(c.values()) * total // words
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                        for t in _terms(text) if c[t])
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(scores, key=lambda s: s[:3])[:top], 1)]
    return sorted(out, key=repr)


def _corpus(seed, n=300, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["É", "naïve", "東京", "ABC", "x1"]
    text = lambda k: " ".join(rng.choices(vocabulary, weights=[1 / (i + 1) for i in range(len(vocabulary))], k=k))
    docs = [(i, text(rng.randrange(1, 40))) for i in range(n)]
    docs += [(n + i, docs[i % 7][1]) for i in range(60)] + [(500, None), (501, ""), (502, "?! -"), (503, text(3000)), (None, text(9)), (3, text(5))]
    items = [(i, text(rng.randrange(1, 12))) for i in range(12)] + [(20, None), (21, "..."), (22, "unknown"), (0, text(4)), (None, "w1 W1 w2")]
    return docs, items


def _got(spark, docs, items, **how):
    found = lx.ranked(spark.createDataFrame(docs, "doc_id long, text string"),
                      spark.createDataFrame(items, "item_id long, text string"), **how)
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_terms():
    assert lx.terms("A-b_C1 É x\x7fy\x00z ß東") == [t.encode() for t in _terms("A-b_C1 É x\x7fy\x00z ß東")]


@pytest.mark.parametrize("seed, how", [(1, {}), (2, {"block": 7}), (3, {"most": 1}), (4, {"top": 3, "block": 50})])
def test_against_all_documents(spark, seed, how):
    docs, items = _corpus(seed)
    assert _got(spark, docs, items, **how) == _expected(docs, items, how.get("top", lx.TOP))


def test_items_in_several_trees_and_passes(spark, monkeypatch):
    docs, items = _corpus(5)
    monkeypatch.setattr(lx, "GROUP", 5)
    assert _got(spark, docs, items) == _expected(docs, items)
    monkeypatch.setattr(lx, "PASS", 20)
    assert _got(spark, docs, items) == _expected(docs, items)


def test_bounds_hold_and_leave_nodes_out():
    rng = np.random.default_rng(2)
    sizes = rng.integers(0, 30, 3_000)
    sets = [np.unique(np.minimum(rng.zipf(1.3, s), 200) - 1) for s in sizes]
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    ids, m = np.concatenate(sets).astype(np.int32), rng.integers(75, 200, len(sets))
    tfs = rng.integers(1, 9, len(ids)).astype(np.int32)
    tree = lx.grow(m, starts, ids, tfs, 200)
    leaves = [i for i, kids in enumerate(tree.children) if not kids]
    assert sorted(x for i in leaves for x in range(tree.low[i], tree.high[i])) == list(range(len(sets)))
    for own, kids in enumerate(tree.children):
        for kid in kids:
            assert (tree.most[kid] <= tree.most[own]).all() and tree.least_m[kid] >= tree.least_m[own]
    asked, weights = np.array([3, 17, 150]), np.array([500, 2_000, 7_000])
    parts = np.zeros(len(sets), np.int64)
    for place in range(len(sets)):
        for t, w in zip(asked, weights):
            at = np.flatnonzero(ids[starts[place]:starts[place + 1]] == t)
            if len(at):
                parts[place] += w * lx.part_score(tfs[starts[place] + at[0]].astype(np.int64), m[place])
    want = np.lexsort((np.arange(len(sets)), -parts))[:20]
    best, scores = lx.search(tree, asked, weights, 20)
    assert best.tolist() == want.tolist() and scores.tolist() == parts[want].tolist()
    small = lx.grow(m, starts, ids, tfs, 200, nodes=3)
    assert lx.search(small, asked, weights, 20)[0].tolist() == want.tolist()


def test_empty_tables_and_other_columns(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b", 2, "x")], "item_id long, text string, row long, term string")
    assert lx.ranked(docs, items).count() == 0 and lx.ranked(items.selectExpr("item_id doc_id", "text"), docs.selectExpr("doc_id item_id", "text")).count() == 0
    clash = spark.createDataFrame([(1, "a b", 9, 9, 9, 9), (2, "b", 9, 9, 9, 9)], "doc_id long, text string, doc int, n int, ids int, tfs int")
    assert [(r.doc, r["rank"]) for r in lx.ranked(clash, items).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    strings = spark.createDataFrame([("p", "a a"), ("q", "a a"), ("", "c")], "doc_id string, text string")
    assert [r.doc for r in lx.ranked(strings, items).orderBy("rank").collect()] == ["p", "q"]


def test_query_against_all_documents(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert sorted((tuple(r) for r in lx.op13_lexical_search(spark, sf).collect()), key=repr) == _expected(docs, items)
