"""Joins on the row key, set operations on names, long and wide result tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabkit.functions.expr import q


def attach_columns(df: DataFrame, other: DataFrame, cols: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Add columns of another table with the same row key."""
    return df.join(other.select(*[q(k) for k in key], *[q(c) for c in cols]), list(key), "left")


def side_by_side(tables: Mapping[str, DataFrame], key: Sequence[str]) -> DataFrame:
    """Column concatenation under name prefixes, aligned on a key; absent rows give nulls."""
    parts = [
        df.select(*[q(k) for k in key], *[q(c).alias(f"{name}_{c}") for c in df.columns if c not in key])
        for name, df in tables.items()
    ]
    return reduce(lambda a, b: a.join(b, list(key), "full"), parts)


def append(tables: Sequence[DataFrame]) -> DataFrame:
    """Row append by column name."""
    return reduce(lambda a, b: a.unionByName(b), tables)


def set_ops(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Membership of each distinct value: rows ``(value, in_a, in_b)``.

    Intersection, differences and union are filters of this one table.
    """
    tagged = (
        a.select(q(col).alias("value"), F.lit(1).alias("_a"), F.lit(0).alias("_b"))
        .unionByName(b.select(q(col).alias("value"), F.lit(0).alias("_a"), F.lit(1).alias("_b")))
    )
    return tagged.groupBy("value").agg((F.max("_a") == 1).alias("in_a"), (F.max("_b") == 1).alias("in_b"))


def melt(df: DataFrame, id_vars: Sequence[str], name: str = "variable", value: str = "value") -> DataFrame:
    """Wide to long, nulls kept."""
    rest = [c for c in df.columns if c not in id_vars]
    return df.unpivot([q(i) for i in id_vars], [q(c) for c in rest], name, value)


def pivot_results(long: DataFrame, datasets: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Long ``(dataset, model, metric, value)`` to one row per model with columns ``<dataset>_<metric>``."""
    names = [f"{d}_{m}" for d in datasets for m in metrics]
    return (
        long.withColumn("_c", F.concat_ws("_", "dataset", "metric"))
        .groupBy("model").pivot("_c", names).agg(F.first("value"))
    )


def top_k_union(comparison: DataFrame, datasets: Sequence[str], k: int) -> DataFrame:
    """The ``k`` best models of each dataset, stacked, with an empty column for the test score."""
    order = Window.partitionBy("dataset").orderBy("cv_rmse", "model")
    return (
        comparison.filter(q("dataset").isin(list(datasets)))
        .withColumn("_r", F.row_number().over(order)).filter(q("_r") <= k)
        .select(F.concat_ws("_", "model", "dataset").alias("name"), F.lit(None).cast("double").alias("test_rmse"))
    )
