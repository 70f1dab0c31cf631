"""Byte-level BPE over length-bucketed numpy matrices.

The pieces of a slice of texts are made distinct, sorted into buckets by length and
padded to matrices with a row for each piece. Every round looks up the ranks of all
adjacent pairs in a hash table, merges the leftmost pair of least rank in each row and
moves the rest of the row up; rows without a known pair leave the matrix.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import carried, schema_with, text_slices, unused

#: Bytes of pieces and ids that a worker remembers before it starts anew, and what a piece takes besides its own.
REMEMBERED, OVERHEAD = 32 << 20, 160

#: Longer pieces, in bytes, are merged by a heap instead of a row of a matrix.
LONGEST_ROW = 256

#: Elements of a matrix at most.
MATRIX = 1 << 21

_NONE = np.int32((1 << 31) - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a line for each token, base64 text and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class PairTable:
    """Open-addressed table from a pair of token ids to the rank of their joined bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, _NONE, np.int32)
        key, value = np.array(keys, np.int64), np.array(values, np.int32)
        slot = self._slot(key)
        while len(key):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = key[free]  # of several for one slot the last stays
            placed = self.keys[slot] == key
            self.values[slot[placed]] = value[placed]
            key, value = key[~placed], value[~placed]
            slot = (slot[~placed] + 1) & (len(self.keys) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``_NONE`` where it has none or where an id is below zero."""
        key = left.astype(np.int64) << 32 | right
        out = np.full(len(key), _NONE, np.int32)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        slot = self._slot(key[open_])
        while len(open_):
            found = self.keys[slot]
            hit = found == key[open_]
            out[open_[hit]] = self.values[slot[hit]]
            on = ~hit & (found != -1)
            open_, slot = open_[on], (slot[on] + 1) & (len(self.keys) - 1)
        return out


def _without(matrix: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Compaction: each row loses one element, and what stands right of it moves up."""
    keep = np.ones(matrix.shape, bool)
    keep[np.arange(len(matrix)), column] = False
    return matrix[keep].reshape(len(matrix), -1)


class Codec:
    """Encodes pieces to ids and ids to bytes. One for each worker and rank file."""

    def __init__(self, ranks: dict[bytes, int]):
        self.known = ranks
        self.pairs = PairTable(ranks)
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of each piece. A piece that is a token as a whole is that token."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            if (rank := self.known.get(piece)) is not None:
                out[i] = np.array([rank], np.int32)
            elif len(piece) > LONGEST_ROW:
                out[i] = self._long(piece)
            else:
                buckets.setdefault(-(-len(piece) // 4) * 4, []).append(i)
        for width, rows in buckets.items():
            step = max(1, MATRIX // width)
            for at in range(0, len(rows), step):
                self._merge_rows(pieces, rows[at: at + step], width, out)
        return out

    def _merge_rows(self, pieces: list[bytes], rows: list[int], width: int, out: list) -> None:
        size = np.array([len(pieces[i]) for i in rows], np.int64)
        ids = np.full((len(rows), width), -1, np.int32)
        ids[np.arange(width) < size[:, None]] = self.byte_id[np.frombuffer(b"".join(pieces[i] for i in rows), np.uint8)]
        row = np.array(rows)
        ranks = self.pairs.ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(rows), -1)
        while len(row):
            at = ranks.argmin(axis=1)  # the leftmost of the least
            every = np.arange(len(row))
            best = ranks[every, at]
            over = best == _NONE
            if over.any():
                for k in np.flatnonzero(over):
                    out[row[k]] = ids[k, : size[k]]
                on = ~over
                ids, ranks, row, size, at, best = ids[on], ranks[on], row[on], size[on], at[on], best[on]
                every = np.arange(len(row))
            if not len(row):
                return
            ids[every, at] = best
            ids = _without(ids, at + 1)
            ranks = _without(ranks, at)
            size -= 1
            for place in (at - 1, at):  # the two pairs that the new token stands in
                which = np.flatnonzero((place >= 0) & (place < ranks.shape[1]))
                where = place[which]
                ranks[which, where] = self.pairs.ranks(ids[which, where], ids[which, where + 1])

    def _long(self, piece: bytes) -> np.ndarray:
        """The same merges over a linked list and a heap, in n log n for a piece of n bytes."""
        ids = [int(x) for x in self.byte_id[np.frombuffer(piece, np.uint8)]]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.pairs.ranks(np.array(ids[:-1]), np.array(ids[1:]))
        heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != _NONE]
        heapq.heapify(heap)

        def push(i: int) -> None:
            if i >= 0 and (j := after[i]) < n:
                rank = int(self.pairs.ranks(np.array([ids[i]]), np.array([ids[j]]))[0])
                if rank != _NONE:
                    heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i] if ids[i] == left else n
            if j >= n or ids[j] != right:
                continue  # one of the two was merged meanwhile
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            push(before[i])
            push(i)
        return np.array([x for x in ids if x >= 0], np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        size = self.size[ids]
        ends = np.cumsum(size)
        if not len(ends):
            return b""
        place = np.arange(ends[-1]) + np.repeat(self.start[ids] - (ends - size), size)
        return self.bytes[place].tobytes()


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(read_ranks(path))


class _Memory:
    """The ids of the pieces seen so far, as one flat array with offsets."""

    def __init__(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.size = np.zeros(0, np.int64)
        self.start = np.zeros(0, np.int64)
        self.bytes = 0

    def learn(self, pieces: Iterable[str], code: Codec) -> None:
        new = [p for p in pieces if p not in self.index]
        if not new:
            return
        coded = code.encode_pieces([p.encode() for p in new])
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
        self.bytes += sum(len(p) + 4 * len(c) for p, c in zip(new, coded)) + OVERHEAD * len(new)
        size = np.array([len(c) for c in coded], np.int64)
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, *coded])

    def encode(self, pieces: list[str]) -> np.ndarray:
        which = np.fromiter(map(self.index.__getitem__, pieces), np.int64, len(pieces))
        size = self.size[which]
        ends = np.cumsum(size)
        if not len(ends):
            return np.zeros(0, np.int32)
        return self.ids[np.arange(ends[-1]) + np.repeat(self.start[which] - (ends - size), size)]


def _encoded(batches: Iterator[pa.RecordBatch], text: str, code: Codec, pattern: str) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Runs of rows and the ids of each row's text."""
    split, memory = regex.compile(pattern).findall, _Memory()
    for rows, texts in text_slices(batches, text):
        pieces = [split(t) for t in texts]
        memory.learn(set().union(*pieces), code)
        yield rows, [memory.encode(p) for p in pieces]
        if memory.bytes > REMEMBERED:
            memory = _Memory()


def _id_lists(coded: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(c) for c in coded]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(coded)))


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of ``docs`` (all but the text if None) and ``ids array<int>``.

    Each match of ``pattern`` is encoded by itself with the ranks of ``path``, a file
    that every executor has; there are no special tokens. A NULL text gives no ids; texts of any length
    are whole. Rows given more than once each get their row, an empty table gives none. A column of ``docs``
    named ``ids`` gives way.
    """
    keep = carried(docs, text_col, keep, "ids")
    text = unused("_text", docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, coded in _encoded(batches, text, codec(path), pattern):
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in keep), _id_lists(coded)], [*keep, "ids"])

    return docs.select(*keep, F.col(text_col).alias(text)).mapInArrow(run, schema_with(docs, keep, "ids array<int>"))


def decode(coded: DataFrame, path: str, ids_col: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of ``coded`` (all if None) and ``decoded binary``; NULL ids decode to nothing.

    Rows given more than once each get their row, an empty table gives none. A column named ``decoded`` gives way.
    """
    keep = [c for c in (coded.columns if keep is None else keep) if c != "decoded"]
    ids = unused("_ids", coded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path)
        for batch in batches:
            texts = (code.decode(x.values.to_numpy()) if x.is_valid else b"" for x in batch.column(ids))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(texts, pa.binary())], [*keep, "decoded"])

    return coded.select(*keep, F.col(ids_col).alias(ids)).mapInArrow(run, schema_with(coded, keep, "decoded binary"))


def round_trip(docs: DataFrame, path: str, pattern: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """What ``decode`` gives for ``encode``: ``keep`` columns, ``ids`` and ``decoded``, in one pass of one worker.

    Two passes in a row would hold two workers for each core, with the ranks in both.
    """
    keep = carried(docs, text_col, keep, "ids", "decoded")
    text = unused("_text", docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path)
        for rows, coded in _encoded(batches, text, code, pattern):
            decoded = pa.array((code.decode(ids) for ids in coded), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in keep), _id_lists(coded), decoded], [*keep, "ids", "decoded"])

    return docs.select(*keep, F.col(text_col).alias(text)).mapInArrow(
        run, schema_with(docs, keep, "ids array<int>, decoded binary"))


def op9_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return round_trip(docs, path, pattern).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
