"""Byte-level byte-pair encoding and decoding over numpy matrices.

Pieces of a text (matches of a pattern) that are no token themselves are put into padded matrices of
pieces of about one length. In each round every row merges its leftmost pair of the lowest rank; the
pairs are looked up in a hash table, and the row is compacted over the gap. Rows without a pair left
are taken out. Pieces beyond the widest matrix, where rounds over full rows would cost the square of the
length, are merged with a heap in the same order.

A tokenizer's files are given by path and read once per Python worker.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import map_texts, small_batches

PAD = (1 << 17) - 1
NONE = np.int32(2**31 - 1)
WIDTHS = (2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 24, 32, 48, 64, 96, 128)
_CELLS = 1 << 20
_KNOWN_PIECES = 200_000
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Open-addressing hash table from pairs of ids to the id of the merged token."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, NONE, np.int32)
        slots, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[slots[left]] < 0]
            _, first = np.unique(slots[free], return_index=True)
            put = free[first]
            self.keys[slots[put]], self.values[slots[put]] = keys[put], values[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            slots[left] = (slots[left] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MULTIPLIER) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 17 | right).ravel()
        slots = self._slots(keys)
        seen = self.keys[slots]
        found = np.where(seen == keys, self.values[slots], NONE)
        open_at = np.flatnonzero((seen != keys) & (seen >= 0))
        while len(open_at):
            slots[open_at] = (slots[open_at] + 1) & self.mask
            seen = self.keys[slots[open_at]]
            hit = seen == keys[open_at]
            found[open_at[hit]] = self.values[slots[open_at[hit]]]
            open_at = open_at[~hit & (seen >= 0)]
        return found.reshape(left.shape)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class Tokenizer:
    """Ranks from a file of base64 tokens and ranks; ids are ranks."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(t): int(r) for t, r in (x.split() for x in lines if x.strip())}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 17 | b] = rank
        self.pairs = PairTable(np.fromiter(pairs.keys(), np.int64, len(pairs)),
                               np.fromiter(pairs.values(), np.int32, len(pairs)))
        self.pieces_of = regex.compile(pattern).findall
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.token_sizes = np.array([len(t) for t in self.tokens], np.int64)
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes
        # Known pieces: a number for each, and where its ids stand in one array.
        self.numbers: dict[str, int] = {}
        self.starts = self.sizes = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int32)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each text has; none for null and for the empty text."""
        pieces = [self.pieces_of(t) if t else [] for t in texts]
        wanted = set().union(*pieces)
        new = wanted - self.numbers.keys()
        if len(self.numbers) + len(new) > _KNOWN_PIECES:
            self._forget(wanted - new)
        self._learn(list(new))
        counts = np.array([len(p) for p in pieces], np.int64)
        number = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(pieces)), np.int64, counts.sum())
        sizes = self.sizes[number]
        ids = self.pool[spread(self.starts[number], sizes)]
        until = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
        return ids, np.diff(until)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all tokens in a row, and how many each token has."""
        sizes = self.token_sizes[ids]
        return self.bytes[spread(self.token_starts[ids], sizes)], sizes

    def _forget(self, keep: set[str]) -> None:
        """Forget all pieces but those that are in use just now."""
        old = np.fromiter((self.numbers[p] for p in keep), np.int64, len(keep))
        self.numbers = {p: i for i, p in enumerate(keep)}
        self.pool = self.pool[spread(self.starts[old], self.sizes[old])]
        self.sizes = self.sizes[old]
        self.starts = np.cumsum(self.sizes) - self.sizes

    def _learn(self, new: list[str]) -> None:
        pieces = [p.encode() for p in new]
        starts, sizes = np.empty(len(new), np.int64), np.empty(len(new), np.int64)
        whole = np.fromiter(map(self.ranks.get, pieces, repeat(-1)), np.int64, len(new))
        width = np.searchsorted(WIDTHS, np.fromiter(map(len, pieces), np.int64, len(new)))
        width[whole >= 0] = -1
        parts, at = [self.pool], len(self.pool)

        def put(members: np.ndarray, ids: np.ndarray, each: np.ndarray) -> None:
            nonlocal at
            starts[members], sizes[members] = at + np.cumsum(each) - each, each
            parts.append(ids.astype(np.int32))
            at += len(ids)

        one = np.flatnonzero(whole >= 0)
        put(one, whole[one], np.ones(len(one), np.int64))
        for i in np.flatnonzero(width == len(WIDTHS)):
            ids = np.array(self._merge_long(pieces[i]), np.int32)
            put(np.array([i]), ids, np.array([len(ids)]))
        for w, columns in enumerate(WIDTHS):
            members = np.flatnonzero(width == w)
            for first in range(0, len(members), _CELLS // columns):
                part = members[first:first + _CELLS // columns]
                rows = self._merge_rows([pieces[i] for i in part], columns)
                used = rows != PAD
                put(part, rows[used], used.sum(axis=1))
        self.numbers.update(zip(new, range(len(self.sizes), len(self.sizes) + len(new))))
        self.pool = np.concatenate(parts)
        self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes])

    def _merge_rows(self, pieces: list[bytes], width: int) -> np.ndarray:
        lengths = np.array([len(p) for p in pieces])
        done = np.full((len(pieces), width), PAD, np.int32)
        done[np.arange(width) < lengths[:, None]] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        ids, rows = done.copy(), np.arange(len(pieces))
        ranks = self.pairs.find(ids[:, :-1], ids[:, 1:])
        while len(rows) and ranks.shape[1]:
            every = np.arange(len(rows))
            at = ranks.argmin(axis=1)
            best = ranks[every, at]
            live = best != NONE
            if not live.all():
                done[rows[~live]] = PAD
                done[rows[~live], :ids.shape[1]] = ids[~live]
                ids, ranks, rows, at, best = ids[live], ranks[live], rows[live], at[live], best[live]
                every = np.arange(len(rows))
            columns = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, columns + (columns > at[:, None]), axis=1)
            ids[every, at] = best
            columns = columns[:-1]
            ranks = np.take_along_axis(ranks, columns + (columns > at[:, None]), axis=1)
            for shift in (-1, 0):
                fits = np.flatnonzero((at + shift >= 0) & (at + shift < ranks.shape[1]))
                where = at[fits] + shift
                ranks[fits, where] = self.pairs.find(ids[fits, where], ids[fits, where + 1])
        done[rows] = PAD
        done[rows, :ids.shape[1]] = ids
        return done

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n, tokens, rank_of = len(ids), self.tokens, self.ranks.get
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                rank = rank_of(tokens[ids[i]] + tokens[ids[j]])
                if rank is not None:
                    heap.append((rank, i, ids[i], ids[j])) if not started else heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        started = False
        for i in range(n):
            offer(i)
        heapq.heapify(heap)
        started = True
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return tuple(x for x in ids if x >= 0)


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str) -> Tokenizer:
    return Tokenizer(path, pattern)


def encode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``<key>, ids array<int>`` for every row.

    Whole texts are encoded, each match of ``pattern`` separately and without special tokens. Null and
    empty texts have no ids. Repeated rows each get a row; other columns are not read.
    """
    import pyarrow as pa

    def work(texts):
        ids, counts = tokenizer(path, pattern).encode(texts)
        return [pa.ListArray.from_arrays(pa.array(_offsets(counts), pa.int32()), pa.array(ids))]

    return map_texts(df, key, text, work, "ids array<int>")


def _offsets(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)])


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``, the bytes of ``ids``; null ids give no bytes. An unknown id is an error."""
    import pyarrow as pa
    from pyspark.sql.types import BinaryType, StructType

    schema = StructType([*df.schema.fields]).add("decoded", BinaryType())
    at = df.columns.index(ids)
    small_batches(df.sparkSession)

    def run(batches):
        for batch in batches:
            lists = batch.column(at)
            flat, sizes = tokenizer(path, pattern).decode(lists.flatten().to_numpy())
            counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            offsets = _offsets(sizes)[_offsets(counts)].astype(np.int32)
            decoded = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(flat)])
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], names=schema.names)

    return df.mapInArrow(run, schema)


def round_trip(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``<key>, ids array<int>, decoded binary``: the ids of every text and the bytes that they stand for.

    Texts are encoded and decoded slice by slice in one task, so the ids go to no second worker. Rows are treated as
    by ``encode``; null and empty texts decode to no bytes.
    """
    import pyarrow as pa

    def work(texts):
        coder = tokenizer(path, pattern)
        ids, counts = coder.encode(texts)
        flat, sizes = coder.decode(ids)
        offsets = _offsets(sizes)[_offsets(counts)].astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(_offsets(counts), pa.int32()), pa.array(ids)),
                pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])]

    return map_texts(df, key, text, work, "ids array<int>, decoded binary")


def digests(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Number of tokens, and SHA-256 of the ids (decimal, joined by a space) and of the decoded bytes."""
    both = round_trip(df, path, pattern, key, text)
    return both.select(
        key, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
