"""Mergeable centred moments of features and label per fold: one scan feeds every linear fit and its validation."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.functions.expr import q, quoted

FEW_LEVELS = 64  # columns up to which partial moments are small enough for fewer levels of grouping


def moments(df: DataFrame, features: Sequence[str], label: str, fold: str) -> DataFrame:
    """Rows ``(fold, a, b, value)``: sums of products of all column pairs, ``1`` being the constant."""
    names = ["1", *features, label]
    col = {"1": F.lit(1.0), **{c: q(c).cast("double") for c in names[1:]}}
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    sums = df.groupBy(q(fold).alias("fold")).agg(*[F.sum(col[a] * col[b]).alias(f"m{i}") for i, (a, b) in enumerate(pairs)])
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"m{i}").alias("value")) for i, (a, b) in enumerate(pairs)]
    return sums.select("fold", F.inline(F.array(*rows)))


def centred_moments(df: DataFrame, features: Sequence[str], label: str, fold: str) -> DataFrame:
    """Rows ``(fold, a, b, n, mean_a, mean_b, value)``: centred sums of products of all column pairs of complete rows.

    Spark merges counts, means and centred products of partial groups pairwise, so no digits of columns far from 0 are lost.
    """
    names = [*features, label]
    col = {c: q(c).cast("double") for c in names}
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    rows = df.select(q(fold).alias("fold"), *[col[c].alias(f"c{i}") for i, c in enumerate(names)]).na.drop()
    at = {c: f"c{i}" for i, c in enumerate(names)}
    sums = rows.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(at[c]).alias(f"mean_{at[c]}") for c in names],
        *[F.covar_pop(at[a], at[b]).alias(f"m{i}") for i, (a, b) in enumerate(pairs)])
    out = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), q("n"), q(f"mean_{at[a]}").alias("mean_a"), q(f"mean_{at[b]}").alias("mean_b"),
                    (q(f"m{i}") * q("n")).alias("value")) for i, (a, b) in enumerate(pairs)]
    return sums.select("fold", F.inline(F.array(*out)))


@dataclass(frozen=True)
class Moments:
    """Weight, means and centred sums of products of ``[features, label]``; two of them add up to those of all rows."""

    n: float
    mean: np.ndarray
    c: np.ndarray

    @staticmethod
    def none(d: int) -> Moments:
        return Moments(0.0, np.zeros(d), np.zeros((d, d)))

    @staticmethod
    def of(x: np.ndarray, w: np.ndarray | None = None) -> Moments:
        """Of the rows of a matrix, each counted ``w`` times."""
        w = np.ones(len(x)) if w is None else w
        n = float(w.sum())
        if n <= 0:
            return Moments.none(x.shape[1])
        mean = w @ x / n
        x = x - mean
        return Moments(n, mean, (x * w[:, None]).T @ x)

    def __add__(self, other: Moments) -> Moments:
        if not self.n or not other.n:
            return self if self.n else other
        n = self.n + other.n
        apart = other.mean - self.mean
        return Moments(n, self.mean + apart * (other.n / n), self.c + other.c + np.outer(apart, apart) * (self.n * other.n / n))

    def columns(self, at: Sequence[int]) -> Moments:
        """Of some of the columns, in the order given."""
        return Moments(self.n, self.mean[list(at)], self.c[np.ix_(at, at)])

    def mapped(self, constant: np.ndarray, basis: np.ndarray) -> Moments:
        """Of the columns ``constant + basis.T @ column``."""
        return Moments(self.n, constant + basis.T @ self.mean, basis.T @ self.c @ basis)

    def pack(self) -> bytes:
        return np.concatenate([[self.n], self.mean, self.c.ravel()]).tobytes()

    @staticmethod
    def unpack(raw: bytes) -> Moments:
        v = np.frombuffer(bytes(raw))
        d = int(((4 * len(v) - 3) ** 0.5 - 1) / 2)
        return Moments(float(v[0]), v[1 : d + 1], v[d + 1 :].reshape(d, d))


def pooled(parts: Sequence[Moments]) -> Moments:
    """Moments of all parts together, merged pairwise."""
    parts = list(parts)
    while len(parts) > 1:
        parts = [parts[i] + parts[i + 1] if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def rest_by_fold(folds: Mapping[int, Moments]) -> dict[int, Moments]:
    """For each fold the moments of all others, merged and never subtracted."""
    keys = sorted(folds)
    none = Moments.none(len(folds[keys[0]].mean)) if keys else None
    before, after = [none], [none]
    for k in keys:
        before.append(before[-1] + folds[k])
    for k in reversed(keys):
        after.append(folds[k] + after[-1])
    return {k: before[i] + after[len(keys) - 1 - i] for i, k in enumerate(keys)}


def gram_by_fold(
    df: DataFrame, features: Sequence[str], label: str, fold: Column | None = None, weight: Column | None = None
) -> dict[int, Moments]:
    """Moments of ``[features, label]`` per fold, rows with nulls left out.

    The driver receives folds x (d + 1)^2 numbers whatever the row count: one matrix product per Arrow batch, the partial
    moments being merged in levels of grouping so that no task gathers all of them.
    """
    found = moments_by_weight(df, [*features, label], [weight if weight is not None else F.lit(1)], fold)
    return {f: m for (f, _), m in found.items()}


def moments_by_weight(
    df: DataFrame, columns: Sequence[str], weights: Sequence[Column], fold: Column | None = None
) -> dict[tuple[int, int], Moments]:
    """Moments of some columns per ``(fold, number of the weighting)``: many weightings of the rows in one scan."""
    rows = df.select(
        *[F.expr(f"CAST({quoted(c)} AS DOUBLE) AS c{i}") for i, c in enumerate(columns)],
        (fold if fold is not None else F.lit(0)).cast("int").alias("_f"),
        *[w.cast("double").alias(f"_w{i}") for i, w in enumerate(weights)],
    ).na.drop()
    d, every = len(columns), len(weights)

    def partial(batches):
        held: dict[int, Moments] = {}
        for pdf in batches:
            x = pdf[[f"c{i}" for i in range(d)]].to_numpy(dtype=float)
            f = pdf["_f"].to_numpy()
            for k in np.unique(f):
                own = f == k
                for i in range(every):
                    m = Moments.of(x[own], pdf[f"_w{i}"].to_numpy()[own])
                    at = int(k) * every + i
                    held[at] = held[at] + m if at in held else m
        if held:
            yield pd.DataFrame({"_f": list(held), "g": [m.pack() for m in held.values()]})

    merge = lambda blocks: pooled([Moments.unpack(b) for b in blocks]).pack()
    got = merged_partials(rows.mapInPandas(partial, "_f int, g binary"), merge, small=d <= FEW_LEVELS)
    return {(k // every, k % every): Moments.unpack(g) for k, g in got.items()}


def merged_partials(parts: DataFrame, merge: Callable[[Sequence[bytes]], bytes], small: bool = False) -> dict[int, bytes]:
    """Merge per ``_f`` the blocks ``g`` that the tasks of a scan left, in levels of grouping."""
    def add(key, pdf):
        return pd.DataFrame([[*key, merge(list(pdf["g"]))]])

    parts = parts.withColumn("_slot", F.spark_partition_id())
    # a hundred thousand partials become a hundred per group, then thirty-two, then thirty-two; small ones go in two steps
    for slots in (64, 1) if small else (1024, 32, 1):
        parts = (
            parts.withColumn("_slot", q("_slot") % slots)
            .groupBy("_f", "_slot").applyInPandas(add, "_f int, _slot int, g binary")
        )
    return {r["_f"]: bytes(r["g"]) for r in parts.collect()}


def add_partials(parts: DataFrame) -> dict[int, np.ndarray]:
    """Sum per ``_f`` of the number blocks ``g`` that the tasks of a scan left."""
    add = lambda blocks: np.sum([np.frombuffer(b) for b in blocks], axis=0).tobytes()
    return {f: np.frombuffer(g) for f, g in merged_partials(parts, add).items()}


def squared_error(m: Moments, intercept: float, coef: np.ndarray) -> float:
    """Mean squared error of a linear model on the rows behind some moments."""
    v = np.append(-np.asarray(coef), 1.0)
    off = v @ m.mean - intercept
    return float(max(v @ m.c @ v, 0.0) / m.n + off * off)


def held_out_rmse(folds: Mapping[int, Moments], fit: Callable[[Moments], tuple[float, np.ndarray]]) -> float:
    """Root of the mean over folds of held-out mean squared error; no further scan of the data."""
    rest = rest_by_fold(folds)
    return float(np.sqrt(np.mean([squared_error(m, *fit(rest[f])) for f, m in folds.items()])))
