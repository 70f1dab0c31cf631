"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

A count c is quantised to 1 + floor(log_b c); the n-gram is put into the filter once
for each level up to its own. To read a count, levels are probed from 1 up until one
is missing. The filter cannot miss what was put in; it overstates a count with the
probability of a false hit. Each segment of the filter has bits for the entries counted
in it, so that this probability is the same for any input; a filter too large for one
broadcast is read in passes of some segments each. Exact word counts, which the base score needs, do not go
through the filter: frequent words, whose number is bounded, are sent to the workers,
and the occurrences of other words meet their counts in a shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import ASCII_LOWER, discard, schema_with, shared_path, stored, text_slices, unused

#: Longest n-gram of the model. Each further order adds as many probes to a score and entries to the filter
#: as there are different n-grams; the tests run order 3.
ORDER = 2

#: Base of the logarithm that counts are rounded down to.
BASE = 2.0

#: Hashes of an entry and bits for each: a false hit has the probability
#: (1 - exp(-HASHES / BITS)) ** HASHES, 1.7 %, for any input.
HASHES, BITS = 3, 10

#: Bytes of the filter that are broadcast at a time.
PASS_BYTES = 1 << 27

#: Parts of the filter at least, each built in a task of its own, and n-grams that meet
#: in a part at most; there are more parts where that asks for them.
SEGMENTS, GROUP = 256, 1 << 22

#: Words that make up more than 1 / FREQUENT of all tokens: fewer than FREQUENT, sent to all workers.
FREQUENT = 100_000

#: Weight of each order's estimate; the rest goes to the next lower order.
TRUST = 0.6

#: N-grams that a task folds at a time, and words that a worker keeps hashes of.
_FOLD = 1 << 21
_REMEMBERED = 150_000

_END, _START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_MUL, _MUL2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def held_out(id_col: Column, folds: int = 5, fold: int = 1) -> Column:
    """Whether crc32 of the id's text falls in the fold; a NULL id never does."""
    return F.coalesce(F.crc32(id_col.cast("string")) % folds == fold, F.lit(False))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MUL
    h = (h ^ (h >> np.uint64(32))) * _MUL2
    return h ^ (h >> np.uint64(31))


def ngrams(tokens: np.ndarray, starts: np.ndarray, order: int) -> np.ndarray:
    """Hashes of the n-grams that end at each token; those reaching before a text hold start marks.

    ``tokens`` has the token hashes of several texts in a row, ``starts`` the place in
    the own text of each.
    """
    if order == 1:
        return mix(tokens)
    h = np.zeros(len(tokens), np.uint64)
    for back in range(order - 1, -1, -1):
        shifted = np.concatenate([np.full(min(back, len(tokens)), _START), tokens[: len(tokens) - back]])
        h = mix(h * _MUL + np.where(starts >= back, shifted, _START) + np.uint64(order))
    return h


class Words:
    """Numbers of words with their hashes, remembered within bounds."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}
        self.words: list[bytes] = []
        self.hashes = np.zeros(0, np.uint64)

    def numbers(self, words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
        """The number of each word, and the words that are numbered for the first time."""
        if len(self.known) > _REMEMBERED:
            self.__init__()
        known = self.known
        new = [w for w in set(words) if w not in known]
        known.update(zip(new, range(len(known), len(known) + len(new))))
        self.words += new
        self.hashes = np.concatenate([self.hashes, np.array([xxhash.xxh64_intdigest(w, 1) for w in new], np.uint64)])
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words)), new


def _split(texts: list[str]) -> tuple[list[bytes], np.ndarray]:
    """The words of all texts in a row, and the tokens of each text: its words and its end."""
    split = [t.encode().translate(ASCII_LOWER).split() for t in texts]
    return [w for s in split for w in s], np.array([len(s) + 1 for s in split], np.int64)


def _with_ends(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes with each text's end, and each token's place in its text."""
    tokens = np.full(int(sizes.sum()), _END, np.uint64)
    ends = np.cumsum(sizes) - 1
    inner = np.ones(len(tokens), bool)
    inner[ends] = False
    tokens[inner] = hashes
    return tokens, np.arange(len(tokens)) - np.repeat(ends + 1 - sizes, sizes)


def _five_bytes(hashes: np.ndarray) -> bytes:
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _from_five(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return wide.view("<u8").ravel()


def _segments_of(hashes: np.ndarray, segments: int) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64) * segments >> 24


def _gathered(order: int, segments: int):
    """Counts of words, and of hashed n-grams by segment: packed hashes with counts up to 65,535."""

    def packed(pieces: list[np.ndarray]) -> Iterator[tuple[int, bytes, bytes]]:
        found, counts = np.unique(np.concatenate(pieces), return_counts=True)
        again = -(-counts // 65_535)
        if (again > 1).any():
            first = np.cumsum(again) - again
            last = counts - (again - 1) * 65_535
            counts = np.full(int(again.sum()), 65_535)
            counts[first] = last
            found = np.repeat(found, again)
        segment = _segments_of(found, segments)
        cuts = np.searchsorted(segment, np.arange(segments + 1))
        for s in range(segments):
            part = slice(cuts[s], cuts[s + 1])
            if part.start < part.stop:
                yield s, _five_bytes(found[part]), counts[part].astype("<u2").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["segment", "hashes", "counts", "word", "n"]
        words, tally, pieces, held = Words(), Counter(), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal tally, pieces, held
            if tally:
                n = len(tally)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()),
                     pa.array(tally.keys(), pa.binary()), pa.array(tally.values(), pa.int64())], names)
            if pieces:
                segment, hashes, counts = zip(*packed(pieces))
                n = len(segment)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(segment, pa.int32()), pa.array(hashes, pa.binary()), pa.array(counts, pa.binary()),
                     pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64())], names)
            tally, pieces, held = Counter(), [], 0

        for _, texts in text_slices(batches, "text"):
            flat, sizes = _split(texts)
            numbers, _ = words.numbers(flat)
            tokens, places = _with_ends(words.hashes[numbers], sizes)
            tally.update(flat)
            tally[b" "] += len(sizes)  # the end of a text; no word is a space
            pieces += [ngrams(tokens, places, n) for n in range(1, order + 1)]
            held += order * len(tokens)
            if held >= _FOLD:
                yield from flush()
        yield from flush()

    return run


def _levels(counts: np.ndarray, base: float) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / np.log(base) + 1e-9).astype(np.int64)


def _positions(rest: np.ndarray, level: int, bits: int | np.ndarray) -> list[np.ndarray]:
    """Bit places within segments of ``bits`` bits (below 2 ** 32) for 40-bit hashes at a level."""
    h = mix(rest * _MUL2 + np.uint64(level))
    step = (h >> np.uint64(32)) | np.uint64(1)
    low, bits = np.uint64((1 << 32) - 1), np.asarray(bits, np.uint64)
    return [((((h + np.uint64(k) * step) & low) * bits) >> np.uint64(32)).astype(np.int64) for k in range(HASHES)]


def _segment(base: float, bits_each: int):
    """The bits of one segment, as many as its entries ask for, from the packed counts that meet there."""

    def run(table: pa.Table) -> pa.Table:
        hashes = _from_five(b"".join(x.as_py() for x in table.column("hashes")))
        counts = np.frombuffer(b"".join(x.as_py() for x in table.column("counts")), "<u2").astype(np.int64)
        order = np.argsort(hashes, kind="stable")
        hashes, counts = hashes[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
        hashes, counts = hashes[first], np.add.reduceat(counts, first)
        levels = _levels(counts, base)
        entries = int(levels.sum())
        bits = np.zeros(-(-entries * bits_each // 64) * 64, bool)
        for level in range(1, int(levels.max()) + 1):
            for at in _positions(hashes[levels >= level], level, len(bits)):
                bits[at] = True
        data = np.packbits(bits, bitorder="little").tobytes()
        return pa.table({"segment": pa.array([table.column("segment")[0].as_py()], pa.int32()),
                         "entries": pa.array([entries], pa.int64()), "size": pa.array([len(data)], pa.int64()),
                         "data": pa.array([data], pa.binary())})

    return run


@dataclass
class Filter:
    """Some of the filter's segments in one array of bytes, and what is needed to read them."""

    data: np.ndarray  # the segments in order, and a byte that is never set
    starts: np.ndarray  # of each segment from ``first`` on
    sizes: np.ndarray  # bytes of each; nothing was put into one of none
    first: int
    segments: int  # of the whole filter
    base: float

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """The highest level of each n-gram that all probes below hit; its segment has to be among the filter's."""
        segment = _segments_of(hashes, self.segments) - self.first
        begin, bits = self.starts[segment], self.sizes[segment] * 8
        rest = hashes & np.uint64((1 << 40) - 1)
        level = np.zeros(len(hashes), np.int64)
        still = np.flatnonzero(bits)
        at = 0
        while len(still) and at < 64:
            at += 1
            own = begin[still]
            hit = np.ones(len(still), bool)
            for place in _positions(rest[still], at, bits[still]):
                hit &= (self.data[own + (place >> 3)] >> (place & 7).astype(np.uint8)) & 1 == 1
            still = still[hit]
            level[still] = at
        return level

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        """Estimated counts: the least count of each n-gram's level."""
        return _least(self.levels(hashes), self.base)


def _least(levels: np.ndarray, base: float) -> np.ndarray:
    return np.concatenate(([0.0], base ** np.arange(64, dtype=np.float64)))[levels]


@dataclass
class Model:
    filter: Filter | None  # None where it is read in passes
    base: float
    order: int
    tokens: int
    types: int
    frequent: dict[bytes, int]

    def log_probabilities(self, tokens: np.ndarray, places: np.ndarray, levels: np.ndarray | None = None) -> np.ndarray:
        """log10 of each token's smoothed probability given the tokens before it.

        ``levels`` has a row for each order, looked up before; without it the filter is read.

        From the unigram up, an order's share of its context's count is mixed with the
        next lower order. An n-gram never counts for more than its context or its last
        word does, which takes back part of what false hits add.
        """
        def counts(n: int) -> np.ndarray:
            return self.filter.counts(ngrams(tokens, places, n)) if levels is None else _least(levels[n - 1], self.base)

        floor = 0.5 / (self.tokens + 0.5 * (self.types + 1))
        lower = counts(1)
        p = lower / (self.tokens + 0.5 * (self.types + 1)) + floor
        for n in range(2, self.order + 1):
            whole = counts(n)
            # The context is the n-gram of the token before; at the start of a text, as many as texts.
            before = np.concatenate([lower[:1], lower[:-1]])
            context = np.where(places == 0, np.maximum(self.starts, 1.0), before)
            whole = np.minimum(whole, np.minimum(lower, context))
            p = np.where(context > 0, TRUST * whole / np.maximum(context, 1.0) + (1 - TRUST) * p, p)
            lower = whole
        return np.log10(np.minimum(p, 1.0))

    def levels(self, alone: np.ndarray, tokens: np.ndarray, places: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        """The levels of each order, of which ``alone`` has those of the words by themselves."""
        one = np.empty(len(tokens), np.int64)
        ends = np.zeros(len(tokens), bool)
        ends[np.cumsum(sizes) - 1] = True
        one[~ends] = alone
        one[ends] = self.filter.levels(mix(np.array([_END])))
        return [one, *(self.filter.levels(ngrams(tokens, places, n)) for n in range(2, self.order + 1))]

    def alone(self, known: np.ndarray, words: Words, new: list[bytes]) -> np.ndarray:
        """By a word's number the level of the word by itself: a frequent word has many, and is looked up once."""
        before = len(words.known) - len(new)
        return np.concatenate([known[:before], self.filter.levels(mix(words.hashes[before:]))])

    @property
    def starts(self) -> float:
        return float(self.frequent.get(b" ", 0))


@dataclass
class Parts:
    """The filter's segments in a stored table, and the ranges of them that are broadcast in turn."""

    table: DataFrame
    sizes: np.ndarray  # bytes of each segment
    base: float
    cuts: list[int]  # where each range begins, and the number of segments

    def load(self, at: int) -> Filter:
        first, end = self.cuts[at: at + 2]
        sizes = self.sizes[first:end]
        starts = np.cumsum(sizes) - sizes
        data = np.zeros(int(sizes.sum()) + 1, np.uint8)
        for row in self.table.filter(F.col("segment").between(first, end - 1)).select("segment", "data").toLocalIterator():
            begin = int(starts[row.segment - first])
            data[begin: begin + len(row.data)] = np.frombuffer(row.data, np.uint8)
        return Filter(data, starts, sizes, first, len(self.sizes), self.base)


def _cuts(sizes: np.ndarray, most: int) -> list[int]:
    """Ranges of segments of ``most`` bytes together, or of one larger segment."""
    cuts, held = [0], 0
    for at, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            cuts.append(at)
            held = 0
        held += size
    return [*cuts, len(sizes)]


def train(docs: DataFrame, text_col: str = "text", order: int = ORDER, base: float = BASE, segments: int = SEGMENTS,
          pass_bytes: int = PASS_BYTES, frequent: int = FREQUENT, group: int = GROUP, bits: int = BITS) -> tuple[Model, DataFrame]:
    """The model of the texts, and the exact count of every word (word binary, n; the end as a space).

    NULL texts are empty ones, which teach an end; texts given more than once count each time. Without texts nothing
    is known. ``bits`` of the filter for each entry bound the false hits.
    """
    texts = docs.select(F.col(text_col).alias("text"))
    given = texts.agg(F.sum(F.char_length("text")).alias("chars"), F.count("*").alias("rows")).first()
    most = order * ((given.chars or 0) // 2 + 2 * given.rows)  # n-grams: no text has more tokens than that
    while segments * group < most and segments < 1 << 24:
        segments *= 2
    path = shared_path(docs.sparkSession, "gathered")
    gathered = stored(texts.mapInArrow(
        _gathered(order, segments), "segment int, hashes binary, counts binary, word binary, n long"), "gathered", path)
    vocabulary = stored(gathered.filter("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n")), "words")
    sums = vocabulary.agg(F.sum("n").alias("tokens"), F.count("*").alias("types")).first()
    tokens, types = sums.tokens or 0, sums.types
    often = vocabulary.filter((F.col("n") * frequent > tokens) | (F.col("word") == F.lit(b" ")))
    built = stored(gathered.filter("segment IS NOT NULL").groupBy("segment").applyInArrow(
        _segment(base, bits), "segment int, entries long, size long, data binary"), "segments")
    discard(docs.sparkSession, path)
    sizes = np.zeros(segments, np.int64)
    for row in built.select("segment", "size").toLocalIterator():
        sizes[row.segment] = row.size
    parts = Parts(built, sizes, base, _cuts(sizes, pass_bytes))
    table = {bytes(r.word): r.n for r in often.toLocalIterator()}
    model = Model(parts.load(0) if len(parts.cuts) == 2 else None, base, order, tokens, types, table)
    model.parts = parts  # of the driver only
    return model, vocabulary


def _looked_up(inputs: DataFrame, model: Model) -> DataFrame:
    """(_row, _levels): the levels of each text's n-grams as (part, levels), read in a pass for each part of the filter.

    The levels of a part are in the order of the text's n-grams, those of order 1 first.
    """
    spark, parts, order, every = inputs.sparkSession, model.parts, model.order, None
    for at in range(len(parts.cuts) - 1):
        sent = spark.sparkContext.broadcast(parts.load(at))

        def run(batches: Iterator[pa.RecordBatch], sent=sent, at=at, end=parts.cuts[at + 1]) -> Iterator[pa.RecordBatch]:
            own, words = sent.value, Words()
            for rows, texts in text_slices(batches, "_text"):
                flat, sizes = _split(texts)
                numbers, _ = words.numbers(flat)
                tokens, places = _with_ends(words.hashes[numbers], sizes)
                hashes = np.stack([ngrams(tokens, places, n) for n in range(1, order + 1)])
                segment = _segments_of(hashes, own.segments)
                mine = (segment >= own.first) & (segment < end)
                levels = np.zeros(hashes.shape, np.uint8)
                levels[mine] = own.levels(hashes[mine])
                ends = np.cumsum(sizes)
                found = [levels[:, s:e][mine[:, s:e]].tobytes() for s, e in zip(ends - sizes, ends)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("_row"), pa.array([at] * len(texts), pa.int32()), pa.array(found, pa.binary())],
                    ["_row", "part", "levels"])

        got = stored(inputs.select("_row", "_text").mapInArrow(run, "_row long, part int, levels binary"), "levels")
        sent.destroy()
        every = got if every is None else every.unionByName(got)
    return every.groupBy("_row").agg(F.collect_list(F.struct("part", "levels")).alias("_levels"))


def _joined_levels(hashes: np.ndarray, ends: np.ndarray, sizes: np.ndarray, looked: list, cuts: list[int], segments: int) -> np.ndarray:
    """The levels of all n-grams of a slice of texts from what the passes found for each text."""
    part = np.searchsorted(np.array(cuts), _segments_of(hashes, segments), side="right") - 1
    levels = np.zeros(hashes.shape, np.uint8)
    for s, e, found in zip(ends - sizes, ends, looked):
        for one in found:
            levels[:, s:e][part[:, s:e] == one["part"]] = np.frombuffer(one["levels"], np.uint8)
    return levels


def score(docs: DataFrame, model: Model, vocabulary: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns of ``docs`` with n_tokens, n_known, base_score and score.

    ``score`` is the sum over a text's words and its end of the model's log10
    probabilities, ``base_score`` the same with exact counts of single words. A NULL
    text is an empty one, which has its end alone; texts of any length are scored whole.
    Rows given more than once each get their row, an empty table gives none. Columns by
    the names of the results give way.
    """
    spark = docs.sparkSession
    parts = model.parts
    cuts, segments, passes = parts.cuts, len(parts.sizes), model.filter is None
    # A filter of at most ``pass_bytes``, or none, and ``frequent`` words.
    sent = spark.sparkContext.broadcast(replace(model))
    divisor = model.tokens + 0.5 * (model.types + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, words = sent.value, Words()
        often = {w: float(np.log10((n + 0.5) / divisor)) for w, n in own.frequent.items()}
        end = often.get(b" ", float(np.log10(0.5 / divisor)))
        exact = np.zeros(0)  # by a word's number: its part of the base score, NaN for words that are not frequent
        alone = np.zeros(0, np.int64)
        for rows, texts in text_slices(batches, text):
            flat, sizes = _split(texts)
            numbers, new = words.numbers(flat)
            exact = np.concatenate([exact[: len(words.known) - len(new)], [often.get(w, np.nan) for w in new]])
            tokens, places = _with_ends(words.hashes[numbers], sizes)
            ends = np.cumsum(sizes)
            if passes:
                hashes = np.stack([ngrams(tokens, places, n) for n in range(1, own.order + 1)])
                levels = _joined_levels(hashes, ends, sizes, rows.column(seen).to_pylist(), cuts, segments)
            else:
                alone = own.alone(alone, words, new)
                levels = own.levels(alone[numbers], tokens, places, sizes)
            total = np.add.reduceat(own.log_probabilities(tokens, places, levels), ends - sizes)
            logs = exact[numbers]
            text_of = np.repeat(np.arange(len(sizes)), sizes - 1)
            unknown = np.isnan(logs)
            base = np.bincount(text_of, np.where(unknown, 0.0, logs), len(sizes)) + end
            known = np.bincount(text_of[~unknown], minlength=len(sizes)) + (b" " in often)
            rare, times = np.unique(text_of[unknown] << 32 | numbers[unknown], return_counts=True)
            names = pa.array([words.words[i] for i in (rare & 0xFFFFFFFF).tolist()], pa.binary())
            edges = np.searchsorted(rare >> 32, np.arange(len(sizes) + 1)).astype(np.int32)
            tails = pa.ListArray.from_arrays(edges, pa.StructArray.from_arrays([names, pa.array(times)], ["word", "times"]))
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in keep), pa.array(sizes), pa.array(known, pa.int64()),
                 pa.array(base, pa.float64()), pa.array(total), tails],
                [*keep, "n_tokens", known_col, base_col, "score", rare_col])

    keep = [c for c in keep if c not in ("n_tokens", "n_known", "base_score", "score")]
    known_col, base_col, rare_col, row = (unused(n, docs) for n in ("_known", "_base", "_rare", "_row"))
    more = (f"n_tokens long, {known_col} long, {base_col} double, score double, "
            f"{rare_col} array<struct<word: binary, times: bigint>>")
    text, seen = unused("_text", docs), unused("_levels", docs)
    inputs = docs.select(*keep, F.col(text_col).alias(text))
    if passes:
        inputs = stored(inputs.withColumn(row, F.monotonically_increasing_id()), "texts")
        found = _looked_up(inputs.select(F.col(row).alias("_row"), F.col(text).alias("_text")), model)
        inputs = inputs.join(found.select(F.col("_row").alias(row), F.col("_levels").alias(seen)), row)
    scored = stored(inputs.mapInArrow(run, schema_with(docs, keep, more)).withColumn(
        row, F.monotonically_increasing_id()), "scored")
    rare = scored.select(F.col(row).alias("row"), F.inline(rare_col)).join(vocabulary, "word", "left")
    plus, rest = unused("_more", docs), unused("_rest", docs)
    sums = rare.groupBy(F.col("row").alias(row)).agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias(plus),
        F.sum(F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(divisor))).alias(rest))
    return scored.join(sums, row, "left").select(
        *keep, "n_tokens", (F.col(known_col) + F.coalesce(plus, F.lit(0))).alias("n_known"),
        (F.col(base_col) + F.coalesce(rest, F.lit(0.0))).alias("base_score"), "score")


def op8_lm_score(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    model, vocabulary = train(docs.filter("NOT held_out"))
    found = score(docs, model, vocabulary, ["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
                        "base_score", "score")
