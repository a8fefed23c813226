"""Binned distributions: the numbers behind histograms, density curves, violins and scatters."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.functions.expr import q
from tabkit.operators.ordering import quantiles, to_long
from tabkit.operators.rows import mask_non_positive
from tabkit.session import settle, sized_join


def column_ranges(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float, int]]:
    """Minimum, maximum and non-null count per column as driver scalars, from one pass."""
    row = df.agg(*[
        e for i, c in enumerate(cols)
        for e in (F.min(q(c)).cast("double").alias(f"a{i}"), F.max(q(c)).cast("double").alias(f"b{i}"),
                  F.count(q(c)).alias(f"n{i}"))
    ]).first()
    return {c: (row[f"a{i}"], row[f"b{i}"], row[f"n{i}"]) for i, c in enumerate(cols)}


def bin_index(x: Column, lo: float, hi: float, bins: int) -> Column:
    """Equal-width bin of a value; the maximum falls in the last bin."""
    width = (hi - lo) / bins
    if width == 0:
        return F.when(x.isNotNull(), F.lit(0).cast("bigint"))
    at = F.floor((x.cast("double") - F.lit(lo)) / F.lit(width)).cast("bigint")
    last = F.lit(bins - 1).cast("bigint")
    return F.when(at > last, last).otherwise(at)


def bin_counts(df: DataFrame, cols: Sequence[str], bins: int, ranges, by: Sequence[str] = ()) -> DataFrame:
    """Rows ``(by, column, bin, n)``; at most ``bins`` rows per column leave a task."""
    binned = df.select(*[q(b) for b in by], *[bin_index(q(c), *ranges[c][:2], bins).alias(c) for c in cols])
    return (
        binned.unpivot([q(b) for b in by], [q(c) for c in cols], "column", "bin").filter("bin is not null")
        .groupBy(*[q(b) for b in by], "column", "bin").agg(F.count(F.lit(1)).alias("n"))
    )


def _per_column(values: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for c, v in values.items() for x in (c, float(v))])[q("column")]


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 20) -> DataFrame:
    """Rows ``(column, bin, bin_start, n, density)`` of the non-null values."""
    ranges = {c: r for c, r in column_ranges(df, cols).items() if r[2]}
    if not ranges:
        return bin_counts(df, cols, bins, {c: (0.0, 1.0) for c in cols}).select(
            "column", "bin", F.lit(0.0).alias("bin_start"), "n", F.lit(0.0).alias("density"))
    width = _per_column({c: (b - a) / bins if b > a else 1.0 for c, (a, b, _) in ranges.items()})
    counts = bin_counts(df, list(ranges), bins, ranges)
    return counts.select(
        "column", "bin",
        (_per_column({c: r[0] for c, r in ranges.items()}) + q("bin") * width).alias("bin_start"), "n",
        (q("n") / (_per_column({c: r[2] for c, r in ranges.items()}) * width)).alias("density"),
    )


def log_histogram(df: DataFrame, cols: Sequence[str], bins: int = 20) -> DataFrame:
    """Histogram of the logs of positive values."""
    return histogram(mask_non_positive(df, cols), cols, bins)


def kde(df: DataFrame, cols: Sequence[str], grid: int = 32, bandwidth: float | None = None, fine: int = 256) -> DataFrame:
    """Gaussian density curve of each column on an even grid, evaluated from fine bin counts.

    The work after the binning pass is ``columns x fine x grid`` terms, whatever the row count. The
    bandwidth is a share of the column's range.
    """
    ranges = {c: r for c, r in column_ranges(df, cols).items() if r[2] and r[1] > r[0]}
    h = bandwidth if bandwidth is not None else 0.05
    lo = _per_column({c: r[0] for c, r in ranges.items()})
    span = _per_column({c: r[1] - r[0] for c, r in ranges.items()})
    total = _per_column({c: r[2] for c, r in ranges.items()})
    counts = bin_counts(df, list(ranges), fine, ranges)
    unit = ((q("bin") + 0.5) / fine - q("point") / (grid - 1)) / F.lit(h)
    return (
        counts.withColumn("point", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(grid - 1).cast("bigint"))))
        .groupBy("column", "point").agg(F.sum(q("n") * F.exp(-unit * unit / 2)).alias("_s"))
        .select("column", "point", (lo + span * q("point") / (grid - 1)).alias("x"),
                (q("_s") / (total * span * F.lit(h * math.sqrt(2 * math.pi)))).alias("density"))
    )


def group_distribution(df: DataFrame, by: Sequence[str], response: str) -> DataFrame:
    """Per level of each discrete column: count, extremes and exact quartiles of the response."""
    base = df.filter(q(response).isNotNull()).withColumn("_y", q(response).cast("double"))
    long = to_long(base, by, ids=["_y"], as_type="string").withColumnRenamed("value", "level")
    quarts = quantiles(long, ["column", "level"], "_y", [0.25, 0.5, 0.75])
    named = lambda p, name: F.max(F.when(q("prob") == p, q("quantile"))).alias(name)
    return quarts.groupBy("column", "level").agg(
        F.max("n").alias("n"), F.max("low").alias("low"), named(0.25, "q1"), named(0.5, "median"), named(0.75, "q3"),
        F.max("high").alias("high"),
    )


def group_histogram(df: DataFrame, by: Sequence[str], response: str, bins: int = 20) -> DataFrame:
    """Binned response per level of each discrete column (the outline of a violin)."""
    ranges = column_ranges(df, [response])
    lo, hi, _ = ranges[response]
    long = to_long(
        df.filter(q(response).isNotNull()).withColumn("bin", bin_index(q(response), lo, hi, bins)),
        by, ids=["bin"], as_type="string",
    )
    return long.groupBy("column", q("value").alias("level"), "bin").agg(F.count(F.lit(1)).alias("n"))


def joint_density(df: DataFrame, cols: Sequence[str], response: str, bins: int = 20, smooth: int = 0) -> DataFrame:
    """Two-dimensional binned density of each column with the response.

    ``smooth`` spreads each cell over its neighbours with binomial weights of that radius.
    """
    both = df.filter(q(response).isNotNull())
    ranges = column_ranges(both, [*cols, response])
    out = both.select(
        bin_index(q(response), *ranges[response][:2], bins).alias("y_bin"),
        *[bin_index(q(c), *ranges[c][:2], bins).alias(c) for c in cols],
    ).unpivot("y_bin", [q(c) for c in cols], "column", "x_bin").filter("x_bin is not null")
    cells = out.groupBy("column", "x_bin", "y_bin").agg(F.count(F.lit(1)).alias("n"))
    if smooth:
        w = [math.comb(2 * smooth, i) / 4.0 ** smooth for i in range(2 * smooth + 1)]
        steps = F.array(*[
            F.struct(F.lit(i - smooth).alias("dx"), F.lit(j - smooth).alias("dy"), F.lit(w[i] * w[j]).alias("w"))
            for i in range(len(w)) for j in range(len(w))
        ])
        cells = (
            cells.withColumn("_s", F.explode(steps))
            .groupBy("column", (F.col("x_bin") + F.col("_s.dx")).alias("x_bin"),
                     (F.col("y_bin") + F.col("_s.dy")).alias("y_bin"))
            .agg(F.sum(F.col("n") * F.col("_s.w")).alias("n"))
            .filter(q("x_bin").between(0, bins - 1) & q("y_bin").between(0, bins - 1))
        )
    ylo, yhi, _ = ranges[response]
    area = {c: (ranges[c][1] - ranges[c][0] or 1.0) / bins * ((yhi - ylo or 1.0) / bins) for c in cols}
    totals = settle(out.groupBy("column").agg(F.count(F.lit(1)).alias("_t")))
    return sized_join(cells, totals, "column", "inner").select(
        "column", "x_bin", "y_bin", "n", (q("n") / (q("_t") * _per_column(area))).alias("density")
    )


def scatter_points(
    df: DataFrame, cols: Sequence[str], response: str, log_x: bool = False,
    key: str = "id", sample_share: float | None = None,
) -> DataFrame:
    """Rows ``(key, variable, x, y)``; an optional share of the rows is drawn by key hash."""
    rows = df.filter(q(response).isNotNull())
    if sample_share is not None:
        rows = rows.filter(F.pmod(F.xxhash64(q(key)), F.lit(1_000_000)) < int(sample_share * 1_000_000))
    if log_x:
        rows = mask_non_positive(rows, cols)
    return to_long(rows.withColumn("_y", q(response)), cols, ids=[key, "_y"]).select(
        q(key), q("column").alias("variable"), q("value").alias("x"), q("_y").alias("y")
    )
