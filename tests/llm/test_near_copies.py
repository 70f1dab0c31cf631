"""Near copies and the pipeline against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import near_copies as near


def _shingles(text, size=near.SHINGLE):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i: i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def _groups(texts, least=near.SIMILARITY):
    """Brute force: the smallest id of each text's group."""
    sets = {i: _shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            x, y = sets[i], sets[j]
            if min(len(x), len(y)) >= least * max(len(x), len(y)) and len(x & y) >= least * len(x | y):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def _planted(families=12, copies=8, words=120, seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(3_000)]
    texts = {}
    for _ in range(families):
        base = rng.choices(vocabulary, k=words)
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randrange(0, 5)):
                own[rng.randrange(words)] = rng.choice(vocabulary)
            texts[len(texts)] = " ".join(own)
    return texts


def _table(spark, texts):
    return spark.createDataFrame(list(texts), "doc_id long, text string")


def test_planted_copies(spark):
    texts = _planted()
    want = _groups(texts)
    got = {r.doc_id: r.component_id for r in near.near_copies(_table(spark, texts.items())).collect()}
    assert all(want[g] == want[i] for i, g in got.items())  # never more than brute force
    assert sum(got[i] == want[i] for i in want) >= 0.97 * len(want)


def test_rounds_change_nothing(spark, monkeypatch):
    docs = _table(spark, _planted(families=2, copies=40, seed=6).items())
    whole = Counter(tuple(r) for r in near.near_copies(docs).collect())
    monkeypatch.setattr(near, "FAN", 1)
    monkeypatch.setattr(near, "GROWTH", 2)
    monkeypatch.setattr(near, "SHARE", 3)
    assert Counter(tuple(r) for r in near.near_copies(docs).collect()) == whole


def _kept(spark, texts):
    rows = near.sketches(_table(spark, texts), "doc_id", "text")
    return rows.groupBy("key").agg(*(F.first(c).alias(c) for c in ("fps", "shingles", "n", *near.BITS)))


def test_fingerprints_of_the_same_texts_stand_for_each_other(spark):
    rng = random.Random(4)
    words = [f"w{n}" for n in range(300)]
    texts = _kept(spark, [(i, " ".join(rng.sample(words, 300))) for i in range(9)])  # one bag of words in nine orders
    pairs, members, left = near.candidates(texts)
    assert members.count() == 9 and pairs.count() == 8  # and not nine for each of the tries
    assert [(r.a == r.b, r.ma, r.mb) for r in left.collect()] == [(True, 9, 9)]


def test_fingerprints_whose_texts_have_met_do_not_meet_again(spark):
    rng = random.Random(4)
    words = [f"w{n}" for n in range(300)]
    texts = _kept(spark, [(i, " ".join(rng.sample(words, 300))) for i in range(9)])
    _, members, left = near.candidates(texts)
    alone = texts.select(F.col("key").alias("node"), F.col("key").alias("root"))
    _, more = near._rest(members, left, alone, texts, 2)
    assert more.count() == 1  # nine texts, of which two or so were heads
    _, more = near._rest(members, more, alone, texts, 9)
    assert more.isEmpty()


def _same(spark, texts):
    want = _groups(texts)
    return want, {r.doc_id: r.component_id for r in near.near_copies(_table(spark, texts.items())).collect()}


def test_texts_of_one_word_set(spark):
    """Orders of the same words share all fingerprints; near copies among them are found whichever comes first."""
    rng = random.Random(7)
    words, texts = [f"w{n}" for n in range(150)], {}
    for _ in range(12):
        own = rng.sample(words, k=150)
        texts[len(texts)] = " ".join(own)
        own[40], own[41] = own[41], own[40]
        texts[len(texts)] = " ".join(own)
    want, got = _same(spark, texts)
    assert got == want and len(set(want.values())) == 12


def test_short_texts(spark):
    rng = random.Random(8)
    vocabulary, texts = [f"w{n}" for n in range(5_000)], {}
    for n in (8, 9, 10, 12, 16, 20, 30):
        for _ in range(20):
            own = rng.sample(vocabulary, k=n)
            texts[len(texts)] = " ".join(own)
            texts[len(texts)] = " ".join([*own, rng.choice(vocabulary)])
    want, got = _same(spark, texts)
    assert got == want and len(set(want.values())) < len(texts) / 2 + 10


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one\ttwo"), (6, "one two three"), (6, "one two three"),
            (None, "one two"), (7, "x " * 30_000), (8, "X " * 30_000), (None, "alone")]
    got = Counter(tuple(r) for r in near.near_copies(_table(spark, rows)).collect())
    assert got == Counter([(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6), (6, 6), (None, 4), (7, 7), (8, 7), (None, None)])
    kept = near.drop_near_copies(_table(spark, rows))
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 4, 6, 6, None, 7, None])


def test_empty_and_clashing_names(spark):
    assert near.near_copies(_table(spark, [])).count() == 0
    docs = _table(spark, [(1, "a b c"), (2, "a b c")]).withColumn("key", F.lit("k")).withColumn("component_id", F.lit(9))
    kept = near.drop_near_copies(docs.withColumn("fps", F.lit(1)))
    assert [tuple(r) for r in kept.collect()] == [(1, "a b c", "k", 9, 1)]


@pytest.fixture(scope="module")
def stages(spark, sf):
    """The rows after each stage."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, sf), name)
        out[name] = docs.collect()
    return out


def test_pipeline_stages(stages):
    given, known, single, apart, mixed, coded = stages.values()
    columns = given[0].asDict().keys()
    assert all(rows[0].asDict().keys() == columns for rows in (known, single, apart, mixed))
    letters = [r for r in given if re.search(r"[^\W\d_]", r.text or "")]
    assert len(known) >= 0.98 * len(letters) and all(r.doc_id in {x.doc_id for x in letters} for r in known)

    groups = defaultdict(list)
    for r in known:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r.text)].append((-len(r.text), r.doc_id))
    assert {r.doc_id for r in single} == {min(g)[1] for g in groups.values()}

    want = _groups({r.doc_id: r.text for r in single})
    heads = {r.doc_id for r in apart}
    assert set(want.values()) <= heads  # no group is lost
    assert len(heads - set(want.values())) <= 0.03 * (len(want) - len(set(want.values()))) + 1

    assert {r.doc_id for r in mixed} <= heads
    assert [(*r,) for r in sorted(mixed)] == [(*r[: len(columns)],) for r in sorted(coded, key=lambda r: r[: len(columns)])]


def test_pipeline_tokens(stages):
    import public_tokenizers
    import tiktoken

    from tidemark.llm.bpe import read_ranks

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoding = tiktoken.Encoding("multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})
    for r in stages["byte_bpe"]:
        assert r.round_trip and r.ids == encoding.encode_ordinary(r.text) and r.n_tokens == len(r.ids)
