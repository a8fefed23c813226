"""Periodic runs of words: stretches repeated at least four times over, found in tiles per period octave.

Octave k holds the periods from 2^k to 2^(k+1) - 1. Its boundaries lie 2^(k+1) words apart, so every run has one, c, that its period q follows
twice: words c to c+q and c+q to c+2q are alike. At each boundary the match of the text with itself q words on is extended to the
right and to the left (a Z-function at offsets q of the octave, and one of the reversed text), by hashes of stretches of 2^j words. Both ways
the extension ends at a bound, so a tile of boundaries needs only a margin of words around it and is solved on its own. Fragments of
one document and period that touch are one run: they are shuffled by document and period and stitched.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabkit.llm.shingles import MUL, mixed
from tabkit.session import settle, sized_join

TILE = 1 << 16
LONG_BYTES = 1 << 22
LEAST, TIMES = 6, 4
RUN = "array<struct<start:bigint,period:bigint,length:bigint>>"


def words_of(text: str | None) -> list[bytes]:
    """The stretches without U+0020 and U+0009 to U+000D, as UTF-8."""
    return text.encode().split() if text else []


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal numbers for equal words."""
    table: defaultdict[bytes, int] = defaultdict(count().__next__)
    return np.fromiter(map(table.__getitem__, words), np.int32, len(words))


def tiles(n: int, size: int) -> Iterator[tuple[int, int, int, int]]:
    """``first octave, last octave, first boundary, end``: the tiles of a text of n words. Octaves whose tiles coincide share them."""
    last = (n // TIMES).bit_length() - 1
    if n < LEAST:
        return
    k = 0
    while k <= last:
        width = size if 2 << k <= size // 2 else 4 << k
        top = last if n <= width else k
        while top < last and 2 << top + 1 <= size // 2:
            top += 1
        for start in range(0, n, width):
            yield k, top, start, min(start + width, n)
        k = top + 1


def margins(last: int, start: int, end: int, n: int) -> tuple[int, int]:
    """The words that a tile reads: a boundary distance before it, three after it."""
    return max(0, start - (2 << last)), min(n, end + (6 << last))


def _primes(n: int) -> np.ndarray:
    """Least prime factor of every number up to n."""
    least = np.arange(n + 1)
    for p in range(2, int(n**0.5) + 1):
        if least[p] == p:
            at = least[p * p :: p]
            at[at == np.arange(p * p, n + 1, p)] = p
    return least


def _primitive(c: np.ndarray, q: np.ndarray, k: int, marks: list[np.ndarray], least: np.ndarray) -> np.ndarray:
    """Whether the q words at c are no repetition of a shorter stretch."""
    fine = np.ones(len(c), bool)
    rest = q.copy()
    while (rest > 1).any():
        prime = np.where(rest > 1, least[rest], 1)
        d = np.where(prime > 1, q // prime, q)
        size = q - d
        for j in (k - 1, k):
            at = np.flatnonzero((prime > 1) & (size >> max(j, 0) == 1) & (j >= 0))
            if at.size:
                a, e, h = c[at], c[at] + size[at] - (1 << j), marks[j]
                fine[at] &= ~((h[a] == h[a + d[at]]) & (h[e] == h[e + d[at]]))
        while True:
            again = (prime > 1) & (rest % prime == 0)
            if not again.any():
                break
            rest = np.where(again, rest // prime, rest)
    return fine


def solve(w: np.ndarray, first: int, last: int, start: int, end: int, lo: int, n: int) -> np.ndarray:
    """Rows ``period, from, to``: words i and i + period are alike for from <= i < to; ``w`` begins at word ``lo`` of n.

    Boundaries are those from ``start`` to ``end``. Fragments that reach out of them come at any length, others as runs.
    """
    size, out = len(w), []
    pad = (2 << last) * (size // (2 << last) + 2)
    mark = np.zeros(pad, np.uint64)
    mark[:size] = mixed(w.astype(np.uint64) + np.uint64(1))
    marks = [mark]
    least = _primes(2 << last)
    for k in range(last + 1):
        half, gap = 1 << k, 2 << k
        # marks of twice the length
        above = np.zeros(pad, np.uint64)
        if gap <= size:
            x = marks[k]
            above[: size - gap + 1] = mixed(x[: size - gap + 1] * MUL[0] + x[half : size - half + 1] * MUL[1])
        marks.append(above)
        if k < first:
            continue
        h = marks[k]
        rows = pad // gap
        at = np.flatnonzero(h.reshape(rows, gap)[:, half:] == h[::gap, None])
        c, q = at // half * gap, half + at % half
        good = (c + q + half <= size) & (c + lo >= start) & (c + lo < end)
        c, q = c[good], q[good]
        if not c.size:
            continue
        right = np.zeros(len(c), np.int64)
        for j in range(k + 1, -1, -1):
            fits = c + q + right + (1 << j) <= size
            right += np.where(fits & (marks[j][c + right] == marks[j][np.minimum(c + q + right, pad - 1)]), 1 << j, 0)
        good = right >= q
        c, q, right = c[good], q[good], right[good]
        good = _primitive(c, q, k, marks, least)
        c, q, right = c[good], q[good], right[good]
        left = np.zeros(len(c), np.int64)
        for j in range(k, -1, -1):
            a = c - left - (1 << j)
            b = np.maximum(a, 0)
            left += np.where((a >= 0) & (marks[j][b] == marks[j][b + q]), 1 << j, 0)
        a, b = c - left, c + right
        # touching fragments of one period are one
        order = np.lexsort((a, q))
        a, b, q = a[order], b[order], q[order]
        shift = q * (pad + 1)
        reach = np.maximum.accumulate(b + shift)
        new = np.ones(len(a), bool)
        new[1:] = (a + shift)[1:] > reach[:-1]
        starts = np.flatnonzero(new)
        if not len(starts):
            continue
        b = np.maximum.reduceat(b, starts)
        a, q = a[starts], q[starts]
        long = b - a + q >= np.maximum(LEAST, TIMES * q)
        inside = (a + lo >= start) & ((b + lo < end) | (end >= n))
        for x, y, p in zip(a[long | ~inside].tolist(), b[long | ~inside].tolist(), q[long | ~inside].tolist()):
            if not np.array_equal(w[x:y], w[x + p : y + p]):
                raise ArithmeticError("two stretches share a mark")
            out.append((p, x + lo, y + lo))
    return np.array(out, np.int64).reshape(-1, 3)


def fragments(documents: DataFrame, tile: int = TILE, long_bytes: int = LONG_BYTES) -> DataFrame:
    """``id, mark, period, a, b`` for ``documents (id, text, mark)``.

    The tiles of texts above ``long_bytes`` are rows of their own, dealt over all tasks; those of shorter ones are solved where the text is read.
    """
    kind = documents.schema["id"].dataType.simpleString()
    names = ["id", "mark", "period", "a", "b"]

    def each(text: str | None) -> Iterator[tuple]:
        w = numbered(words_of(text))
        for first, last, start, end in tiles(len(w), tile):
            lo, hi = margins(last, start, end, len(w))
            yield w[lo:hi], first, last, start, end, lo, len(w)

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, found = [], [np.zeros((0, 3), np.int64)]
            for i, x in enumerate(batch.column(1)):
                for t in each(x.as_py()):
                    part = solve(*t)
                    row += [i] * len(part)
                    found.append(part)
            at, rows = pa.array(row, pa.int64()), np.concatenate(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(2).take(at), *[pa.array(rows[:, i].copy()) for i in range(3)]], names)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, x in enumerate(batch.column(1)):
                for w, *numbers in each(x.as_py()):
                    at = pa.array([i])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(at), batch.column(2).take(at), pa.array([w.tobytes()], pa.binary()), *[pa.array([v], pa.int64()) for v in numbers]],
                        ["id", "mark", "words", "first", "last", "start", "end", "lo", "n"])

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, found = [], [np.zeros((0, 3), np.int64)]
            for i in range(batch.num_rows):
                part = solve(np.frombuffer(batch.column(2)[i].as_py(), np.int32), *[batch.column(j)[i].as_py() for j in range(3, 9)])
                row += [i] * len(part)
                found.append(part)
            at, rows = pa.array(row, pa.int64()), np.concatenate(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), *[pa.array(rows[:, i].copy()) for i in range(3)]], names)

    schema = f"id {kind}, mark bigint, period bigint, a bigint, b bigint"
    is_long = F.octet_length("text") > long_bytes
    dealt = documents.filter(is_long).mapInArrow(
        explode, f"id {kind}, mark bigint, words binary, first bigint, last bigint, start bigint, end bigint, lo bigint, n bigint")
    dealt = dealt.repartition(F.xxhash64("mark", "first", "start")).mapInArrow(solved, schema)
    return documents.filter(~F.coalesce(is_long, F.lit(False))).mapInArrow(short, schema).union(dealt)


def stitched(parts: DataFrame) -> DataFrame:
    """``id, mark, start, period, length``: fragments of one document and period that touch are one run."""
    own = Window.partitionBy("id", "mark", "period")
    before = own.orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    new = F.coalesce((F.col("a") > F.max("b").over(before)).cast("int"), F.lit(1))
    numbered_ = parts.withColumn("_new", new).withColumn("_run", F.sum("_new").over(own.orderBy("a", "b").rowsBetween(Window.unboundedPreceding, 0)))
    runs = numbered_.groupBy("id", "mark", "period", "_run").agg(F.min("a").alias("start"), F.max("b").alias("_to"))
    runs = runs.withColumn("length", F.col("_to") - F.col("start") + F.col("period"))
    return runs.filter(F.col("length") >= F.greatest(F.lit(LEAST), TIMES * F.col("period"))).select("id", "mark", "start", "period", "length")


def kept_words(words: list[bytes], runs: list[dict]) -> list[bytes]:
    """Words outside every run, or in its first period."""
    edge = np.zeros(len(words) + 1, np.int64)
    for r in runs:
        edge[r["start"] + r["period"]] += 1
        edge[r["start"] + r["length"]] -= 1
    keep = np.cumsum(edge[:-1]) == 0
    return [w for w, k in zip(words, keep.tolist()) if k]


def collapse_runs(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE, long_bytes: int = LONG_BYTES
) -> DataFrame:
    """``id, runs, collapsed`` per document: its periodic runs by start and period, and its words without their repetitions.

    A run is a stretch of words with smallest period q, at least max(6, 4 q) long, that cannot be extended with that period.
    ``collapsed`` joins the words that no run contains after its first q words by one space.

    A null or empty text has no words: no runs and an empty ``collapsed``. Repeated rows give a row each; null ids are kept. An empty table
    gives no rows. Other columns are not read. A task holds one text or, of texts above ``long_bytes``, one tile besides.
    """
    kind = documents.schema[id_col].dataType.simpleString()
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("mark"))
    # one row per document with runs; equal rows share it
    runs = settle(stitched(fragments(docs, tile, long_bytes)).groupBy("id", "mark").agg(
        F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs")).toDF("_id", "_mark", "runs"))
    both = sized_join(docs, runs, docs["id"].eqNullSafe(F.col("_id")) & (docs["mark"] == F.col("_mark"))).select("id", "text", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for x, r in zip(batch.column(1), batch.column(2)):
                words = words_of(x.as_py())
                texts.append(b" ".join(kept_words(words, r.as_py()) if r.is_valid else words).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(texts, pa.string())], ["id", "runs", "collapsed"])

    out = both.mapInArrow(run, f"id {kind}, runs {RUN}, collapsed string")
    return out.select(F.col("id").alias(id_col), F.coalesce("runs", F.expr(f"CAST(array() AS {RUN})")).alias("runs"), "collapsed")


def run_digest(collapsed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """How many runs each document has, the longest (ties: least start, then period), and hashes of all runs and of ``collapsed``."""
    best = F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))")
    line = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    out = collapsed.select(id_col, "runs", "collapsed", best.alias("_b"))
    return out.select(
        id_col, F.size("runs").cast("long").alias("n_runs"), (-F.col("_b.start")).alias("start"), F.col("_b.length").alias("length"),
        (-F.col("_b.period")).alias("period"), F.expr("1000 * _b.length div -_b.period").alias("exponent_milli"),
        F.sha2(line.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
