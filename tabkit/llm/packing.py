"""Best-fit packing of token sequences, worked out on the counts of each length.

Only lengths decide where a document goes, and there are at most as many of them as a sequence has tokens. So the plan is made
on the driver from one count per length: long items are matched in pairs, short ones fill the tightest gaps, always for
all items of a length at once. The plan says for the k-th to m-th item of a length which sequences and offsets they
get; documents find theirs by their rank among the items of their length.
"""

from __future__ import annotations

import json
import os
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.llm.wordsplit import WordFile, byte_letters, normalised, segments
from tabkit.session import store

CACHE_PIECES = 700_000
#: Below it, word patterns read letters, digits and signs alike in every version of the character tables.
PLAIN = "\u0250"
SALTS = 64


class WordIds:
    """Ids of whole texts by the tokenizers library, asked once for each distinct word."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.file = WordFile(path)
        # words come normalised and without special strings: doing either again would find and compose what the text does not hold
        with open(path, encoding="utf-8") as f:
            bare = json.load(f) | {"added_tokens": [], "normalizer": None}
        self.library = Tokenizer.from_str(json.dumps(bare))
        self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
        self.separators = regex.compile("[\x1c-\x1f]")
        self.tokenize = self.library.model.tokenize
        self.letters = dict(enumerate(byte_letters()))
        self.raw = [i.to_bytes(4, "little") for i in range(self.library.get_vocab_size())]
        # two generations: what is asked for again outlives what came once
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        """Stretches that white space parts; nothing that the file's pattern matches reaches over it."""
        if self.separators.search(text):  # these part words for str.split only
            return self.pattern.findall(text)
        return text.split()

    def piece(self, piece: str) -> bytes:
        """Ids of one match of the file's pattern, by its merges alone."""
        if not (piece.isascii() and piece.isprintable()):
            piece = piece.encode().decode("latin-1").translate(self.letters)
        return b"".join([self.raw[t.id] for t in self.tokenize(piece)])

    def recall(self, words: set[str]) -> None:
        """Bring words into the cache: from the older generation, else by the merges, else by the whole library."""
        strange = []
        for w in words:
            known = self.older.get(w)
            if known is None:
                if max(w) >= PLAIN:
                    strange.append(w)
                    continue
                known = self.piece(w) if w.isalpha() else b"".join([self.cache.get(p) or self.piece(p) for p in self.pattern.findall(w)])
            self.cache[w] = known
        self.learn(strange)

    def learn(self, words: list[str]) -> None:
        """One call for many words: blanks between them part them again, and offsets tell whose each token is."""
        for k in range(0, len(words), 20_000):
            part = words[k : k + 20_000]
            said = self.library.encode(" ".join(part), add_special_tokens=False)
            starts = np.array([a for a, _ in said.offsets], np.int64)
            ends = np.cumsum([len(w) + 1 for w in part])
            cuts = np.concatenate([[0], np.searchsorted(starts, ends)]).tolist()
            raw = np.array(said.ids, "<u4").tobytes()
            self.cache.update((w, raw[4 * a : 4 * b]) for w, a, b in zip(part, cuts, cuts[1:]))

    def encode(self, text: str) -> bytes:
        out = []
        for k, part in enumerate(self.file.parts(text)):
            if k % 2:
                out.append(self.file.special[part].to_bytes(4, "little"))
                continue
            for segment in segments(part):
                words = self.words(normalised(segment))
                new = set(words).difference(self.cache)
                if new:
                    if len(self.cache) + len(new) > CACHE_PIECES // 2:
                        self.older, self.cache = self.cache, {}
                        new = set(words)
                    self.recall(new)
                out.append(b"".join(map(self.cache.__getitem__, words)))
        return b"".join(out)


_WORD_IDS: dict[str, WordIds] = {}


def token_pieces(documents: DataFrame, path: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, piece, start, length, ids_crc32``: each text's ids and ``end_id``, cut at every ``capacity`` tokens."""
    narrow = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = documents.schema[id_col].dataType.simpleString()
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _WORD_IDS:
            _WORD_IDS[path] = WordIds(path)
        encode = _WORD_IDS[path].encode
        for batch in batches:
            row, piece, length, crc = [], [], [], []
            for i, x in enumerate(batch.column(1)):
                ids = encode(x.as_py() or "") + end
                for k in range(0, len(ids), 4 * capacity):
                    part = ids[k : k + 4 * capacity]
                    row.append(i)
                    piece.append(k // (4 * capacity))
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            piece = np.array(piece, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece), pa.array(piece.astype(np.int64) * capacity),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["_id", "piece", "start", "length", "ids_crc32"])

    return narrow.mapInArrow(run, f"_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint").withColumnRenamed("_id", id_col)


class Plan:
    """Where the items of each length go: rows ``length, first rank, first sequence, items per sequence, offset``."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = dict(counts)
        self.ranks = dict.fromkeys(counts, 0)
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0
        self.gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, how many)
        self.sorted_gaps: list[int] = []
        self._match_long()
        self._fill()

    def _place(self, length: int, items: int, first: int, each: int, offset: int) -> None:
        self.rows.append((length, self.ranks[length], first, each, offset))
        self.ranks[length] += items
        self.left[length] -= items

    def _open(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def _gap(self, gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in self.gaps:
                insort(self.sorted_gaps, gap)
            self.gaps.setdefault(gap, []).append((first, n))

    def _match_long(self) -> None:
        """Items above a third of the capacity: the longest takes the longest that still fits beside it."""
        waiting = sorted(n for n in self.left if 3 * n > self.capacity)
        while waiting:
            a = waiting[-1]
            n = self.left[a]
            at = bisect_right(waiting, self.capacity - a) - 1
            b = waiting[at] if at >= 0 else None
            if b is None or (b == a and n == 1):
                lower = at - 1 if b == a else -1
                b = waiting[lower] if lower >= 0 else None
            if b is None:
                first = self._open(n)
                self._place(a, n, first, 1, 0)
                self._gap(self.capacity - a, first, n)
            elif b == a:
                pairs = n // 2
                first = self._open(pairs)
                self._place(a, 2 * pairs, first, 2, 0)
                self._gap(self.capacity - 2 * a, first, pairs)
            else:
                pairs = min(n, self.left[b])
                first = self._open(pairs)
                self._place(a, pairs, first, 1, 0)
                self._place(b, pairs, first, 1, a)
                self._gap(self.capacity - a - b, first, pairs)
            waiting = [x for x in waiting if x not in (a, b) or self.left[x]]

    def _fill(self) -> None:
        """Shorter items, longest first, into the tightest gap that takes them; where none does, into new sequences."""
        for s in sorted((n for n in self.left if 3 * n <= self.capacity), reverse=True):
            while self.left[s]:
                at = bisect_left(self.sorted_gaps, s)
                if at < len(self.sorted_gaps):
                    gap = self.sorted_gaps[at]
                    first, n = self.gaps[gap].pop()
                    if not self.gaps[gap]:
                        del self.gaps[gap], self.sorted_gaps[at]
                else:
                    gap, n = self.capacity, -(-self.left[s] // (self.capacity // s))
                    first = self._open(n)
                each = gap // s
                full = min(n, self.left[s] // each)
                if full:
                    self._place(s, full * each, first, each, self.capacity - gap)
                    self._gap(gap - each * s, first, full)
                rest = self.left[s] if full < n else 0
                if rest:
                    self._place(s, rest, first + full, rest, self.capacity - gap)
                    self._gap(gap - rest * s, first + full, 1)
                    full += 1
                self._gap(gap, first + full, n - full)


def pack_pieces(pieces: DataFrame, capacity: int, id_col: str = "doc_id") -> DataFrame:
    """``pieces`` plus ``sequence_id`` and ``offset``; ``pieces`` must be a stored table (it is read three times)."""
    spark = pieces.sparkSession
    salts = max(SALTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(id_col, "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    # one row per length: at most ``capacity`` rows
    counts = {r[0]: r[1] for r in salted.groupBy("length").count().collect()}
    plan = np.array(sorted(Plan(counts, capacity).rows), np.int64).reshape(-1, 5)
    # the rank among the items of a length: the items of smaller salts, then those before it in its own
    shares = salted.groupBy("length", "_salt").count()
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select(
        F.col("length").alias("_l"), F.col("_salt").alias("_s"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("length", "_salt").orderBy(id_col, "piece", "ids_crc32", "start")) - 1
    ranked = salted.withColumn("_own", own).join(shares, (F.col("length") == F.col("_l")) & (F.col("_salt") == F.col("_s")))
    ranked = ranked.select(*pieces.columns, (F.col("_before") + F.col("_own")).cast("long").alias("_rank"))
    keys = plan[:, 0] << 44 | plan[:, 1]
    at_length, at_rank = ranked.columns.index("length"), ranked.columns.index("_rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(at_length).to_numpy(), batch.column(at_rank).to_numpy()
            row = plan[np.searchsorted(keys, length << 44 | rank, side="right") - 1]
            k = rank - row[:, 1]
            sequence, offset = row[:, 2] + k // row[:, 3], row[:, 4] + k % row[:, 3] * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:-1], "sequence_id", "offset"])

    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(run, schema)


def pack_documents(
    documents: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, piece, start, length, ids_crc32, sequence_id, offset``: every document's ids laid into few sequences.

    Documents above ``capacity`` are cut into pieces of that many tokens and a rest; no other is cut. Items above a
    third of the capacity are matched, at most two to a sequence; shorter ones fill the tightest gaps. Sequences have no holes: each item
    starts where the one before it ends.

    A null or empty text is one item of one token (the end id). Repeated rows are packed each; null ids are kept. An
    empty table gives no rows. Other columns are not read.
    """
    return pack_pieces(store(token_pieces(documents, path, capacity, end_id, id_col, text_col)), capacity, id_col)
