"""Byte-level BPE: encoding by rounds of merges on padded numpy matrices, and decoding.

Distinct pieces are gathered per batch, bucketed by length and padded. In every round each row merges its leftmost pair of
least rank; ranks of pairs come from an open-addressing hash table, rows close their gap, and rows without a pair leave.
Pieces beyond the longest bucket, which would take a round for each byte, are merged with a heap of pairs instead.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.llm.wordsplit import segments

NONE = np.int32(2**31 - 1)
BUCKETS = [2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 20, 24, 32, 48, 64, 128, 256]
CELLS = 1 << 20
CACHE_PIECES = 300_000
BATCH_CHARS = 1 << 21


class PairTable:
    """Rank of the token that two adjacent tokens make, by hash of the two."""

    def __init__(self, pairs: np.ndarray, ranks: np.ndarray):
        self.bits = int(2 * len(pairs) + 1).bit_length()
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        todo, values = pairs, ranks
        slot = self._slot(todo)
        while todo.size:
            free = self.keys[slot] < 0
            self.keys[slot[free]] = todo[free]  # of several rows for one slot the last stays
            won = free & (self.keys[slot] == todo)
            self.ranks[slot[won]] = values[won]
            todo, values, slot = todo[~won], values[~won], (slot[~won] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32 | right.astype(np.int64)).ravel()
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.ranks[slot], NONE)
        todo = np.flatnonzero((found != keys) & (found >= 0))
        while todo.size:
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self.ranks[slot[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
        return out.reshape(left.shape)


class BytePairs:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        rank_of = self.ranks.get
        pairs, made = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = rank_of(token[:cut]), rank_of(token[cut:])
                if a is not None and b is not None:
                    pairs.append(a << 32 | b)
                    made.append(rank)
        self.pairs = PairTable(np.array(pairs, np.int64), np.array(made, np.int32))
        self.cache: dict[str, bytes] = {}

    def _bucket(self, rows: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces of 2 to ``width`` bytes, padded, and how many each row has."""
        lengths = np.array([len(r) for r in rows])
        flat = self.single[np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), np.uint8)].reshape(len(rows), width)
        place = np.arange(width)
        ids = np.where(place < lengths[:, None], flat, -1)
        rank = np.full((len(rows), width), NONE)
        both = place[:-1] + 1 < lengths[:, None]
        rank[:, :-1][both] = self.pairs.look_up(ids[:, :-1][both], ids[:, 1:][both])
        done = np.full((len(rows), width), -1, np.int32)
        sizes = lengths.copy()
        rows_at = np.arange(len(rows))
        while True:
            best = rank.argmin(1)  # the leftmost of equal ranks
            made = rank[np.arange(len(rank)), best]
            ended = made == NONE
            if ended.any():
                done[rows_at[ended], : ids.shape[1]] = ids[ended]
                keep = ~ended
                rows_at, ids, rank, best, made = rows_at[keep], ids[keep], rank[keep], best[keep], made[keep]
            if not rows_at.size:
                return done, sizes
            sizes[rows_at] -= 1
            row = np.arange(len(rows_at))
            ids[row, best] = made
            # close the gap after the merged pair
            width = ids.shape[1]
            source = np.minimum(np.arange(width - 1) + (np.arange(width - 1) > best[:, None]), width - 1)
            ids, rank = np.take_along_axis(ids, source, 1), np.take_along_axis(rank, source, 1)
            right = np.minimum(best + 1, width - 2)
            has_right = (best + 1 < width - 1) & (ids[row, right] >= 0)
            rank[row, best] = np.where(has_right, self.pairs.look_up(ids[row, best], np.maximum(ids[row, right], 0)), NONE)
            left = np.maximum(best - 1, 0)
            again = self.pairs.look_up(ids[row, left], ids[row, best])
            rank[row, left] = np.where(best > 0, again, rank[row, left])

    def _long(self, piece: bytes) -> list[int]:
        """One piece by a heap of its pairs: least rank first, then leftmost."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        token = [bytes([b]) for b in piece]
        heap = []

        def offer(i):
            j = after[i]
            if j >= 0 and (rank := self.ranks.get(token[i] + token[j])) is not None:
                heapq.heappush(heap, (rank, i, token[i], token[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if token[i] != a or j < 0 or token[j] != b:
                continue
            token[i], token[j], ids[i] = a + b, None, rank
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [x for x, t in zip(ids, token) if t is not None]

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece as little-endian 32-bit integers."""
        raw = [p.encode() for p in pieces]
        out: list[bytes] = [b""] * len(raw)
        by_width: dict[int, list[int]] = {}
        for i, r in enumerate(raw):
            whole = self.ranks.get(r)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(r) > BUCKETS[-1]:
                out[i] = np.array(self._long(r), "<u4").tobytes()
            elif r:
                by_width.setdefault(next(w for w in BUCKETS if w >= len(r)), []).append(i)
        for width, rows in by_width.items():
            step = max(1, CELLS // width)
            for k in range(0, len(rows), step):
                part = rows[k : k + step]
                ids, sizes = self._bucket([raw[i] for i in part], width)
                for i, x, n in zip(part, ids.astype("<u4"), sizes.tolist()):
                    out[i] = x[:n].tobytes()
        return out

    def encode(self, texts: Iterable[str]) -> Iterator[list[bytes]]:
        """For each text the ids of its segments, with new pieces of many texts merged together."""
        held: list[tuple[int, list[str]]] = []
        size = texts_seen = 0

        def ready():
            new = set()
            for _, pieces in held:
                new.update(pieces)
            new.difference_update(self.cache)
            if len(self.cache) + len(new) > CACHE_PIECES:
                self.cache.clear()
                new = set().union(*(pieces for _, pieces in held))
            listed = list(new)
            self.cache.update(zip(listed, self.encode_pieces(listed)))
            known = self.cache.__getitem__
            return [(n, b"".join(map(known, pieces))) for n, pieces in held]

        current, parts = 0, []
        for text in texts:
            for segment in segments(text or ""):
                held.append((texts_seen, self.pattern.findall(segment)))
                size += len(segment)
                if size > BATCH_CHARS:
                    for n, ids in ready():
                        while current < n:
                            yield parts
                            current, parts = current + 1, []
                        parts.append(ids)
                    held, size = [], 0
            texts_seen += 1
        for n, ids in ready():
            while current < n:
                yield parts
                current, parts = current + 1, []
            parts.append(ids)
        while current < texts_seen:
            yield parts
            current, parts = current + 1, []

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODERS: dict[tuple[str, str], BytePairs] = {}


def coder(path: str, pattern: str) -> BytePairs:
    if (path, pattern) not in _CODERS:
        _CODERS[path, pattern] = BytePairs(path, pattern)
    return _CODERS[path, pattern]


def encode_documents(documents: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ids``: each whole text's token ids as little-endian unsigned 32-bit integers in one binary value.

    Null and empty texts have no ids. Special tokens are not known: their strings are ordinary text. Repeated rows are
    encoded each; other columns are not read.
    """
    narrow = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = coder(path, pattern).encode(x.as_py() for x in batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([b"".join(p) for p in ids], pa.binary())], ["_id", "ids"])

    kind = documents.schema[id_col].dataType.simpleString()
    return narrow.mapInArrow(run, f"_id {kind}, ids binary").withColumnRenamed("_id", id_col)


def decode_documents(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """``id, text``: the bytes that ``encode_documents`` encoded. Null ids give null."""
    narrow = encoded.select(F.col(id_col).alias("_id"), F.col("ids").alias("_ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            decode = coder(path, pattern).decode
            texts = [None if not x.is_valid else decode(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], ["_id", "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return narrow.mapInArrow(run, f"_id {kind}, text binary").withColumnRenamed("_id", id_col)


def coding_digest(documents: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256`` of every whole text, encoded and decoded segment by segment."""
    narrow = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = coder(path, pattern)
            counts, of_ids, of_text = [], [], []
            for parts in c.encode(x.as_py() for x in batch.column(1)):
                ids, text = hashlib.sha256(), hashlib.sha256()
                for p in parts:
                    ids.update(p)
                    text.update(c.decode(p))
                counts.append(sum(map(len, parts)) // 4)
                of_ids.append(ids.hexdigest())
                of_text.append(text.hexdigest())
            columns = [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = documents.schema[id_col].dataType.simpleString()
    out = narrow.mapInArrow(run, f"_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("_id", id_col)
