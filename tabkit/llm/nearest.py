"""Exact top-k by inner product through a pivot-distance index.

Vectors get one more component that gives all the same length; then the largest inner product is the smallest distance,
and distances obey the triangle inequality. Every vector is keyed by its nearest pivot and its distance to it, and each
pivot's vectors are cut into annuli (cells) of about equal size. A query first looks into the annuli that may be nearest,
until they hold enough rows; the k-th score found there bounds the radius, and only annuli that the radius
reaches are opened after that. Cells and the queries that ask for them meet in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabkit.session import store

CELL_ROWS = 1024
MAX_PIVOTS = 192
BLOCK_ROWS = 4096
SCALE = 256
SLACK = 1e-6


def whole_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``_row, id, dim, square, v``: components ``floor(256 x)`` as 64-bit integers in one binary value."""
    narrow = table.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            lengths = lists.value_lengths().to_numpy()
            flat = lists.flatten()
            values = flat.to_numpy(zero_copy_only=False)  # a null component becomes NaN
            ends = np.cumsum(lengths)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            good = bad[ends] == bad[ends - lengths]
            whole = np.floor(np.where(np.isfinite(values), values, 0) * SCALE).astype(np.int64)
            raw = whole.tobytes()
            squares = np.concatenate([[0.0], np.cumsum(whole.astype(float) ** 2)])
            keep = np.flatnonzero(good)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep)), pa.array(lengths[keep].astype(np.int32)),
                 pa.array([raw[8 * (e - n) : 8 * e] for e, n in zip(ends[keep].tolist(), lengths[keep].tolist())], pa.binary()),
                 pa.array((squares[ends] - squares[ends - lengths])[keep])], ["id", "dim", "v", "square"])

    out = narrow.mapInArrow(run, "id bigint, dim int, v binary, square double")
    return out.withColumn("_row", F.monotonically_increasing_id())


def matrix(raw, dim: int) -> np.ndarray:
    """Rows of ``dim`` components; shorter vectors end in zeros."""
    return np.frombuffer(b"".join(x.ljust(8 * dim, b"\0") for x in raw), np.int64).reshape(len(raw), dim)


class Index:
    """Pivots and cells: bounded tables that every task knows."""

    def __init__(self, pivots: np.ndarray, longest: float, dim: int, exact_floats: bool):
        self.pivots, self.longest, self.dim, self.exact_floats = pivots, longest, dim, exact_floats
        self.borders: list[np.ndarray] = []
        self.cells = np.zeros((0, 5))  # pivot, ring, least and largest distance, rows

    def lifted(self, v: np.ndarray) -> np.ndarray:
        x = v.astype(float)
        return np.concatenate([x, np.sqrt(np.maximum(self.longest - (x * x).sum(1), 0))[:, None]], 1)

    def distances(self, lifted: np.ndarray) -> np.ndarray:
        square = (lifted**2).sum(1)[:, None] + (self.pivots**2).sum(1) - 2 * lifted @ self.pivots.T
        return np.sqrt(np.maximum(square, 0))

    def bounds(self, v: np.ndarray) -> np.ndarray:
        """For queries (which have 0 as their last component) the least distance to each cell."""
        d = self.distances(np.concatenate([v.astype(float), np.zeros((len(v), 1))], 1))[:, self.cells[:, 0].astype(int)]
        return np.maximum(np.maximum(self.cells[:, 2] - d, d - self.cells[:, 3]), 0)

    def radius(self, v: np.ndarray, scores: np.ndarray) -> np.ndarray:
        square = (v.astype(float) ** 2).sum(1) + self.longest - 2 * scores
        return np.sqrt(np.maximum(square, 0))

    def slack(self) -> float:
        return SLACK * (1 + np.sqrt(self.longest))

    def first_cells(self, v: np.ndarray, rows: int) -> np.ndarray:
        """Whether a query looks into a cell at first: nearest cells until they hold ``rows`` rows."""
        order = np.argsort(self.bounds(v), 1, kind="stable")
        before = np.cumsum(self.cells[order, 4], 1) - self.cells[order, 4]
        out = np.zeros(order.shape, bool)
        np.put_along_axis(out, order, before < rows, 1)
        return out


def build_index(vectors: DataFrame, cell_rows: int) -> tuple[Index | None, DataFrame]:
    """The index and ``vectors`` with ``cell`` numbers. Pivots: the vectors of least hash, a bounded number."""
    seen = vectors.agg(F.count(F.lit(1)).alias("n"), F.max("square").alias("longest"), F.max("dim").alias("dim")).first()
    if not seen["n"]:
        return None, vectors
    rings = int(min(MAX_PIVOTS, max(1, np.ceil(np.sqrt(seen["n"] / cell_rows)))))
    chosen = vectors.select("v", F.xxhash64("v").alias("h")).distinct().orderBy("h").limit(rings).select("v").collect()
    index = Index(np.zeros((0, 1)), float(seen["longest"]), max(1, seen["dim"]), seen["longest"] < 2**52)
    index.pivots = index.lifted(matrix([bytes(r[0]) for r in chosen], index.dim))
    at = vectors.columns.index("v")

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = index.distances(index.lifted(matrix(batch.column(at).to_pylist(), index.dim)))
            nearest = d.argmin(1) if len(d) else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(nearest.astype(np.int32)), pa.array(d[np.arange(len(d)), nearest])],
                [*batch.schema.names, "pivot", "dist"])

    keyed = store(vectors.mapInArrow(key, "id bigint, dim int, v binary, square double, _row bigint, pivot int, dist double"))
    shares = [k / rings for k in range(1, rings)]
    cut = keyed.groupBy("pivot").agg(F.percentile_approx("dist", shares, 200).alias("at") if shares else F.array().cast("array<double>").alias("at")).collect()
    borders = {r["pivot"]: np.unique(r["at"] or []) for r in cut}
    index.borders = [borders.get(p, np.zeros(0)) for p in range(len(index.pivots))]
    lists = F.array(*[F.array(*[F.lit(float(b)) for b in bs]).cast("array<double>") for bs in index.borders])
    placed = keyed.withColumn("_borders", F.element_at(lists, F.col("pivot") + 1))
    placed = placed.withColumn("ring", F.size(F.filter("_borders", lambda b: b < F.col("dist"))))
    found = placed.groupBy("pivot", "ring").agg(F.min("dist").alias("low"), F.max("dist").alias("high"), F.count(F.lit(1)).alias("n")).orderBy("pivot", "ring").collect()
    index.cells = np.array([tuple(r) for r in found], float)
    number = F.create_map(*[x for i, r in enumerate(found) for x in (F.lit(r["pivot"] * (MAX_PIVOTS + 1) + r["ring"]), F.lit(i))])
    cells = placed.withColumn("cell", number[F.col("pivot") * (MAX_PIVOTS + 1) + F.col("ring")])
    return index, cells.select("id", "v", "_row", "cell")


def _best(scores: np.ndarray, rows: np.ndarray, ids: np.ndarray, asked: np.ndarray, k: int):
    """For each query the k best of a block: larger score, then smaller id; never the query's own row."""
    for i in range(len(scores)):
        s = scores[i]
        own = rows == asked[i]
        if len(s) > 4 * k:
            least = np.partition(s, len(s) - k - 1)[len(s) - k - 1]
            some = np.flatnonzero(s >= least)
        else:
            some = np.arange(len(s))
        some = some[~own[some]]
        some = some[np.lexsort((ids[some], -s[some]))[:k]]
        yield i, some


def search_cells(asking: DataFrame, cells: DataFrame, index: Index, k: int) -> DataFrame:
    """``query_id, _q, vec_id, score``: the k best rows of each block for each (query, cell) in ``asking``."""
    sizes = cells.groupBy("cell").count().collect()
    asks = asking.groupBy("cell").count().collect()
    v_parts, q_parts = np.ones(len(index.cells), int), np.ones(len(index.cells), int)
    for rows, parts in ((sizes, v_parts), (asks, q_parts)):
        for r in rows:
            parts[r[0]] = -(-r[1] // BLOCK_ROWS)
    of = lambda parts: F.element_at(F.array(*[F.lit(int(p)) for p in parts]), F.col("cell") + 1)
    spread = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    salted_v = cells.withColumns({"_vs": F.pmod(F.xxhash64("_row"), of(v_parts)).cast("int")}).withColumn("_qs", spread(of(q_parts)))
    salted_q = asking.withColumns({"_qs": F.pmod(F.xxhash64("_q", F.lit(1)), of(q_parts)).cast("int")}).withColumn("_vs", spread(of(v_parts)))
    dim, floats = index.dim, index.exact_floats

    def meet(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(v):
            a, b = matrix(q["qv"].tolist(), dim), matrix(v["v"].tolist(), dim)
            ids, rows, asked, names = v["id"].to_numpy(), v["_row"].to_numpy(), q["_q"].to_numpy(), q["query_id"].to_numpy()
            for start in range(0, len(a), 256):
                part = a[start : start + 256]
                # products of whole numbers below 2**52 are exact in doubles
                scores = (part.astype(float) @ b.T.astype(float)).astype(np.int64) if floats else part @ b.T
                for i, some in _best(scores, rows, ids, asked[start : start + 256], k):
                    out.append(pd.DataFrame({"query_id": names[start + i], "_q": asked[start + i], "vec_id": ids[some], "score": scores[i][some]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "_q": [], "vec_id": [], "score": []}).astype("int64")

    keys = ["cell", "_vs", "_qs"]
    return salted_q.groupBy(*keys).cogroup(salted_v.groupBy(*keys)).applyInPandas(meet, "query_id bigint, _q bigint, vec_id bigint, score bigint")


def _asking(queries: DataFrame, index: Index, choose) -> DataFrame:
    """One row per query and chosen cell; ``choose`` gets the query vectors and bounds so far."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = matrix(batch.column(1).to_pylist(), index.dim)
            picked = choose(v, batch.column(3).to_numpy(zero_copy_only=False))
            row, cell = np.nonzero(picked)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), batch.column(2).take(take), pa.array(cell.astype(np.int32))],
                ["query_id", "qv", "_q", "cell"])

    return queries.select("id", "v", "_row", "bound").mapInArrow(run, "query_id bigint, qv binary, _q bigint, cell int")


def top_k(
    table: DataFrame, k: int, every: int, id_col: str = "vec_id", vector_col: str = "embedding", cell_rows: int = CELL_ROWS
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows of largest inner product for each row whose id ``every`` divides.

    Components are ``floor(256 x)``; a score is a 64-bit whole number, which the vectors must not exceed. A query's own
    row is not its candidate, but other rows of its id are; repeated query rows have results each. Ties go to the
    smaller id. Rows with a null id or vector, or a null, NaN or infinite component take no part; a vector shorter than others
    counts as ending in zeros. Where there are fewer than k candidates all are returned; an empty table gives no rows.
    """
    vectors = store(whole_vectors(table, id_col, vector_col))
    index, cells = build_index(vectors, cell_rows)
    if index is None:
        return vectors.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.col("id").alias("score")).limit(0)
    cells = store(cells)
    queries = cells.filter(F.col("id") % every == 0).select("id", "v", "_row")
    unbound = queries.withColumn("bound", F.lit(None).cast("double"))
    rows = 8 * (k + 1)
    first = store(search_cells(_asking(unbound, index, lambda v, _: index.first_cells(v, rows)), cells, index, k))
    best = Window.partitionBy("_q").orderBy(F.desc("score"), "vec_id")
    ranked = first.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    bound = ranked.groupBy("_q").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).cast("double").alias("bound"))
    bounded = queries.join(bound.withColumnRenamed("_q", "_row"), "_row", "left")

    def rest(v, scores):
        radius = np.where(np.isnan(scores), np.inf, index.radius(v, np.nan_to_num(scores)) + index.slack())
        return (index.bounds(v) <= radius[:, None]) & ~index.first_cells(v, rows)

    later = search_cells(store(_asking(bounded, index, rest)), cells, index, k)
    final = first.unionByName(later).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return final.select("query_id", "rank", "vec_id", "score")
