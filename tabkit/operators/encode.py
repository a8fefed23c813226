"""Ordinal codes, one-hot flags, scaling. Every fit is a small parameter set, every apply a projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.functions.expr import q, quoted
from tabkit.operators.depend import apply_level_codes, level_codes
from tabkit.operators.ordering import ordered_prefix
from tabkit.operators.profile import levels_by_first_seen, value_counts
from tabkit.operators.roles import Roles
from tabkit.session import settle

SHOWN = 20  # values named in an error, of a total that it states


def _lookup(c: Column, mapping: Mapping) -> Column:
    known = [(k, v) for k, v in mapping.items() if k is not None]
    null_code = F.lit(mapping.get(None)).cast("bigint")
    out = F.when(c.isNull(), null_code)
    for k, v in known:
        out = out.when(c == F.lit(k), F.lit(v).cast("bigint"))
    return out


def unmapped_levels(df: DataFrame, mapper: Mapping[str, Mapping]) -> DataFrame:
    """Rows ``(column, value, n)`` of values the maps do not cover; a missing null key shows as null."""
    parts = []
    for c, m in mapper.items():
        keys = [str(k) for k in m if k is not None]
        miss = ~q(c).cast("string").isin(keys)
        miss = F.when(q(c).isNull(), F.lit(None not in m)).otherwise(miss)
        parts.append(F.struct(F.lit(c).alias("column"), q(c).cast("string").alias("value"), miss.alias("_miss")))
    return (
        df.select(F.explode(F.array(*parts)).alias("_e")).select("_e.*").filter("_miss")
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def null_mappings(mapper: Mapping[str, Mapping]) -> dict[str, int | None]:
    """What each map makes of a null, for the columns that map it."""
    return {c: m[None] for c, m in mapper.items() if None in m}


def encode_ordinals(df: DataFrame, mapper: Mapping[str, Mapping], check: bool = True) -> DataFrame:
    """Replace values by given codes; ``None`` is a legal key. Values without a code raise."""
    mapper = {c: m for c, m in mapper.items() if c in df.columns}
    if check:
        bad = settle(unmapped_levels(df, mapper))
        total = bad.count()
        if total:
            first = bad.orderBy("column", "value").limit(SHOWN).collect()
            raise ValueError(f"{total} values without a code, the first in order: " + ", ".join(f"{r['column']}={r['value']!r}" for r in first))
    return df.select(*[_lookup(q(c), mapper[c]).alias(c) if c in mapper else q(c) for c in df.columns])


def ordinal_map_from_data(df: DataFrame, col: str, order: Sequence[str]) -> DataFrame:
    """Codes ``(value, code)`` by reversed order of first appearance."""
    seen = levels_by_first_seen(df, col, order).withColumn("_one", F.lit(1).cast("bigint"))
    placed = ordered_prefix(seen, [], list(order), "_one", "_b")
    total = placed.count()
    return placed.select("value", (F.lit(total - 1).cast("bigint") - q("_b")).alias("code"))


def label_encode_ordinals(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Codes of sorted values fitted on one table and applied to another; null and unseen give null."""
    fitted = level_codes(fit_on if fit_on is not None else df, cols)
    return apply_level_codes(df, fitted, cols)


def level_lists(df: DataFrame, cols: Sequence[str], max_levels: int | None = None) -> dict[str, list[str]]:
    """Sorted levels of the columns to be turned into flags; refuses more than ``max_levels`` if that is given."""
    if not cols:
        return {}
    counts = settle(value_counts(df, cols))
    if max_levels is not None and counts.count() > max_levels:
        raise ValueError(f"more than {max_levels} flag columns asked for")
    out: dict[str, list[str]] = {c: [] for c in cols}
    for r in counts.orderBy("column", "value").collect():
        out[r["column"]].append(r["value"])
    return out


def one_hot(
    df: DataFrame, cols: Sequence[str], levels: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """One 0/1 column ``<col>_<level>`` per sorted level; a null is 0 in all of them."""
    levels = levels or level_lists(df, cols)
    kept = [quoted(c) for c in df.columns if c not in cols]
    flags = [
        F.coalesce((q(c).cast("string") == v).cast("int"), F.lit(0)).alias(f"{c}_{v}")
        for c in cols for v in levels[c]
    ]
    return df.select(*kept, *flags)


def fit_min_max(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Minimum and maximum per column, from one pass."""
    if not cols:
        return {}
    row = df.agg(*[
        F.expr(f"CAST({f}({quoted(c)}) AS DOUBLE) AS {t}{i}")
        for i, c in enumerate(cols) for f, t in (("min", "a"), ("max", "b"))
    ]).first()
    return {c: (row[f"a{i}"], row[f"b{i}"]) for i, c in enumerate(cols)}


def apply_min_max(df: DataFrame, params: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Scale to [0, 1]; a constant column becomes 0, a null stays null."""
    def scaled(c: str) -> Column:
        lo, hi = params[c]
        x = f"CAST({quoted(c)} AS DOUBLE)"
        if lo is None:
            return F.expr(x)
        return F.expr(f"({x} - {lo!r}D) * 0D" if hi == lo else f"({x} - {lo!r}D) / {hi - lo!r}D")

    return df.select(*[scaled(c).alias(c) if c in params else quoted(c) for c in df.columns])


def min_max_scale(
    df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None
) -> tuple[DataFrame, dict[str, tuple[float, float]]]:
    """Scale columns to [0, 1] over all rows, or over the rows of ``fit_on``."""
    params = fit_min_max(fit_on if fit_on is not None else df, cols)
    return apply_min_max(df, params), params


def inverse_scale(df: DataFrame, params: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Undo ``min_max_scale``."""
    return df.select(*[
        (q(c) * F.lit(params[c][1] - params[c][0]) + F.lit(params[c][0])).alias(c)
        if c in params and params[c][0] is not None else q(c)
        for c in df.columns
    ])


def round_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Round fractional columns to whole numbers, halves to even."""
    targets = set(cols) if cols is not None else {
        f.name for f in df.schema if isinstance(f.dataType, T.FractionalType)
    }
    return df.select(*[F.bround(q(c), 0).alias(c) if c in targets else q(c) for c in df.columns])


def model_matrix(
    df: DataFrame, roles: Roles, response: str, fit_on: DataFrame | None = None
) -> tuple[DataFrame, list[str]]:
    """Flags for the categorical columns and everything scaled to [0, 1], the response left as it is."""
    fit_on = fit_on if fit_on is not None else df
    roles = roles.within(df)
    cats = [c for c in roles.cat if c != response]
    nums = [c for c in (*roles.ord, *roles.quant) if c != response]
    levels = level_lists(fit_on, cats)
    flagged = one_hot(df, cats, levels)
    params = fit_min_max(one_hot(fit_on, cats, levels), [*nums, *[f"{c}_{v}" for c in cats for v in levels[c]]])
    features = [c for c in flagged.columns if c in params]
    scaled = apply_min_max(flagged, params)
    return scaled.select(*[q(k) for k in roles.key], *[q(f) for f in features], q(response)), features
