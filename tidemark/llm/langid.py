"""Language ID by word-first backoff: known words first, then ever shorter character n-grams."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import carried, lookup, schema_with, stored, text_slices, unused

#: Labelled documents of each language that the model is fitted on, chosen by hash.
SAMPLE = 1_000

#: Lengths of the character n-grams, from the longest down; words are padded by a space.
GRAMS = (5, 4, 3, 2, 1)

#: Weight of a token scored by n-grams against that of a known word.
BACKOFF = 0.5

#: Tokens after which more text no longer sharpens the confidence.
SHARPEST = 40

#: Share of the likeliest language below which a text is rejected.
LEAST = 0.5

_REMEMBERED = 100_000

#: The word and n-gram kinds of an entry: 0 for whole words, else the length.
_ENTRY = "lang string, kind int, gram string, n long"


def held_out(id_col: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether crc32 of the id's text falls in the fold; a NULL id never does."""
    return F.coalesce(F.crc32(id_col.cast("string")) % folds == fold, F.lit(False))


@lru_cache(None)
def _kinds() -> np.ndarray:
    """For each code point 2 for a letter, 1 for a mark, else 0."""
    kinds = {"L": 2, "M": 1}
    return np.fromiter((kinds.get(unicodedata.category(chr(c))[0], 0) for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)


def _cut(text: str) -> tuple[list[str], bool]:
    """The runs of letters and marks of a text in lower case, and whether there is a letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    kinds = _kinds()[codes]
    return np.where(kinds > 0, codes, np.uint32(32)).tobytes().decode("utf-32-le").split(), bool((kinds == 2).any())


def words_of(text: str) -> list[str]:
    return _cut(text)[0]


def grams_of(word: str, size: int) -> list[str]:
    padded = f" {word} "
    return [padded[i: i + size] for i in range(len(padded) - size + 1)]


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words and n-grams for each language, folded for each slice of texts."""
    for rows, texts in text_slices(batches, "text"):
        langs = rows.column("lang").to_pylist()
        words: dict[tuple[str, str], int] = {}
        for lang, text in zip(langs, texts):
            for word in words_of(text):
                words[lang, word] = words.get((lang, word), 0) + 1
        counts = {(lang, 0, word): n for (lang, word), n in words.items()}
        for (lang, word), n in words.items():
            for size in GRAMS:
                for gram in grams_of(word, size):
                    counts[lang, size, gram] = counts.get((lang, size, gram), 0) + n
        lang, kind, gram = zip(*counts) if counts else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(kind, pa.int32()), pa.array(gram, pa.string()),
             pa.array(counts.values(), pa.int64())], ["lang", "kind", "gram", "n"])


def _hashes(kind: int, grams: list[str]) -> np.ndarray:
    """A 64-bit number for each entry of a kind; as a seed the kind would not tell short texts apart."""
    return np.fromiter((xxhash.xxh3_64_intdigest(f"{kind}{g}".encode()) for g in grams), np.uint64, len(grams))


class Model:
    """Log frequencies of entries by language, as rows of a matrix; entries are found by their hash in order."""

    def __init__(self, rows: pa.Table, totals: dict[tuple[str, int], int]):
        """``rows`` (lang, kind, gram, n) are all entries, ``totals`` their occurrences by language and kind."""
        self.langs = sorted({lang for lang, _ in totals})
        kind = rows.column("kind").to_numpy()
        hashes = np.zeros(len(rows), np.uint64)
        for k in np.unique(kind).tolist():
            own = np.flatnonzero(kind == k)
            hashes[own] = _hashes(k, rows.column("gram").take(pa.array(own)).to_pylist())
        self.keys, first, at = np.unique(hashes, return_index=True, return_inverse=True)
        place = {lang: i for i, lang in enumerate(self.langs)}
        lang = np.array([place[x] for x in rows.column("lang").to_pylist()], np.int64)
        counts = np.zeros((len(self.keys), len(self.langs)), np.float32)
        counts[at, lang] = rows.column("n").to_numpy()
        total = np.ones((max(GRAMS) + 1, len(self.langs)))
        for (name, k), n in totals.items():
            total[k, place[name]] = n
        # An entry that a language lacks counts as half an occurrence.
        self.logs = np.log(np.maximum(counts, 0.5) / total[kind[first]]).astype(np.float32)
        self.memory: dict[str, int] = {}
        self.scores = np.zeros((1, len(self.langs)))

    def _places(self, kind: int, grams: list[str]) -> np.ndarray:
        """The row of each entry, -1 for unknown ones."""
        hashes = _hashes(kind, grams)
        if not len(self.keys):
            return np.full(len(grams), -1)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, at, -1)

    def score_words(self, words: list[str]) -> np.ndarray:
        """Log frequencies by language, below the best: of each word, or the mean over its longest known n-grams."""
        out = np.zeros((len(words), len(self.langs)))
        at = self._places(0, words)
        known = at >= 0
        out[known] = self.logs[at[known]]
        left = np.flatnonzero(~known)
        backed = left
        for size in GRAMS:
            if not len(left):
                break
            grams = [grams_of(words[i], size) for i in left.tolist()]
            of = np.repeat(np.arange(len(left)), [len(g) for g in grams])
            at = self._places(size, [g for own in grams for g in own])
            of, at = of[at >= 0], at[at >= 0]
            n = np.bincount(of, minlength=len(left))
            sums = np.zeros((len(left), len(self.langs)))
            np.add.at(sums, of, self.logs[at])
            out[left[n > 0]] = sums[n > 0] / n[n > 0, None]
            left = left[n == 0]
        if out.size:
            out -= out.max(axis=1, keepdims=True)
        out[backed] *= BACKOFF
        return out

    def _learn(self, words: set[str]) -> None:
        """Room for the scores of ``words``; what was remembered before may go."""
        if len(self.memory) > _REMEMBERED:
            self.memory.clear()
        new = [w for w in words if w not in self.memory]
        if not new:
            return
        at = len(self.memory)
        if at + len(new) > len(self.scores):
            self.scores = np.concatenate([self.scores[:at], np.zeros((at + 2 * len(new), len(self.langs)))])
        self.scores[at: at + len(new)] = self.score_words(new)
        self.memory.update(zip(new, range(at, at + len(new))))

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """The likeliest language of each text and its share; ties go to the first by name."""
        cut = [_cut(t) for t in texts]
        self._learn(set().union(*(words for words, _ in cut)))
        return [self._decide(*own) for own in cut]

    def _decide(self, words: list[str], letters: bool) -> tuple[str, float]:
        if not letters or not self.langs:
            return "und", 0.0
        score = self.scores[np.fromiter(map(self.memory.__getitem__, words), np.int64, len(words))].sum(axis=0)
        score *= min(1.0, SHARPEST / len(words))
        share = np.exp(score - score.max())
        share /= share.sum()
        best = int(share.argmax())
        return self.langs[best], float(share[best])


def fit(labelled: DataFrame, id_col: str = "doc_id", sample: int = SAMPLE) -> Model:
    """The model of ``labelled`` (id, text, lang): rows without text or language are passed over.

    ``sample`` whole documents of each language at most are used, those with the least hash of the id, and all that
    they hold is learned. Documents with one id are one. Texts of any length are taken whole; an empty table
    gives a model that knows no language.
    """
    plain = labelled.select(
        F.xxhash64(F.col(id_col).cast("string")).alias("hash"), F.col("lang").alias("lang"), F.col("text").alias("text")).filter(
        "text IS NOT NULL AND lang IS NOT NULL")
    # Of a common language a share by hash is enough, so that no task ranks all of its documents.
    ids = plain.select("lang", "hash").distinct()
    sizes = ids.groupBy("lang").agg(F.count("*").alias("ids"))
    place = F.col("hash").cast("double") / F.lit(float(1 << 64)) + 0.5
    few = lookup(ids, sizes, "lang", "hash").filter(place * F.col("ids") <= 2 * sample + 64)
    order = Window.partitionBy("lang").orderBy("hash")
    limit = stored(few.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= sample).groupBy("lang").agg(
        F.max("hash").alias("most")), "sample")
    chosen = lookup(plain, limit, "lang", "hash").filter("hash <= most").groupBy("lang", "hash").agg(
        F.min("text").alias("text")).select("lang", "text")
    counts = stored(chosen.mapInArrow(_entries, _ENTRY).groupBy("lang", "kind", "gram").agg(F.sum("n").alias("n")), "entries")
    totals = {(r.lang, r.kind): r.n for r in counts.groupBy("lang", "kind").agg(F.sum("n").alias("n")).collect()}
    return Model(counts.toArrow(), totals)  # what ``sample`` documents of each language hold


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of ``docs`` (all but the text if None) with ``lang_pred`` and ``score``.

    ``score`` is the share of the likeliest language among all that were learned, 0 to
    1. A text that is NULL or has no letter is ``und`` with score 0, as is any text
    where nothing was learned. Columns of ``docs`` by the names of the results give way.
    """
    keep = carried(docs, text_col, keep, "lang_pred", "score")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    text = unused("_text", docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, text):
            found = sent.value.predict(texts)
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in keep), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], [*keep, "lang_pred", "score"])

    inputs = docs.select(*keep, F.col(text_col).alias(text))
    return inputs.mapInArrow(run, schema_with(docs, keep, "lang_pred string, score double"))


def keep_known(docs: DataFrame, model: Model, least: float = LEAST, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is in a learned language with a share of ``least`` or more, whole and in no order.

    Rows without text or letters go, rows given more than once stay as often. An empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, text_col):
            found = sent.value.predict(texts)
            yield rows.filter(pa.array([lang != "und" and score >= least for lang, score in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    return predict(docs, fit(docs.filter("NOT held_out")), keep=["doc_id", "held_out"])
