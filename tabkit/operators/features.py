"""Derived columns: recodes, sums, means, flags, ratios, logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.functions.expr import add_all, ln_or, nonzero, q, ratio


def recode(df: DataFrame, rules: Mapping[str, Mapping]) -> DataFrame:
    """Merge levels by old-to-new maps; other values pass, columns not in the table are skipped."""
    def mapped(c: str):
        out = None
        for old, new in rules[c].items():
            hit = q(c) == F.lit(old)
            value = F.lit(new).cast(df.schema[c].dataType)
            out = F.when(hit, value) if out is None else out.when(hit, value)
        return q(c) if out is None else out.otherwise(q(c))

    return df.select(*[mapped(c).alias(c) if c in rules else q(c) for c in df.columns])


def recode_hits(df: DataFrame, rules: Mapping[str, Mapping]) -> DataFrame:
    """Rows ``(column, old, rows)`` of every rule; a rule that matches nothing shows 0."""
    present = [(c, str(old)) for c, m in rules.items() if c in df.columns for old in m]
    counts = df.agg(*[F.count_if(q(c).cast("string") == old).alias(f"r{i}") for i, (c, old) in enumerate(present)])
    names = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(o).alias("o")) for c, o in present])
    return counts.unpivot([], [f"r{i}" for i in range(len(present))], "rule", "rows").select(
        F.element_at(names, F.substring("rule", 2, 9).cast("int") + 1)["c"].alias("column"),
        F.element_at(names, F.substring("rule", 2, 9).cast("int") + 1)["o"].alias("old"), "rows",
    )


def weighted_sum(df: DataFrame, out: str, weights: Mapping[str, float], drop: bool = True) -> DataFrame:
    """Linear combination of columns, the sources dropped on request."""
    made = df.withColumn(out, add_all([q(c) * F.lit(w) for c, w in weights.items()]))
    return made.drop(*weights) if drop else made


def row_mean(df: DataFrame, out: str, cols: Sequence[str]) -> DataFrame:
    """Mean over the row's present values, null when none is."""
    total = add_all([F.coalesce(q(c).cast("double"), F.lit(0.0)) for c in cols])
    present = add_all([q(c).isNotNull().cast("int") for c in cols])
    return df.withColumn(out, F.try_divide(total, present.cast("double")))


def flag_nonzero(df: DataFrame, out: str, col: str) -> DataFrame:
    """1 where a column differs from zero; null counts as different."""
    return df.withColumn(out, nonzero(q(col)))


def flag_any_nonzero(df: DataFrame, out: str, cols: Sequence[str]) -> DataFrame:
    """1 where any of the columns differs from zero."""
    return df.withColumn(out, F.greatest(*[nonzero(q(c)) for c in cols]) if len(cols) > 1 else nonzero(q(cols[0])))


def sum_columns(df: DataFrame, out: str, cols: Sequence[str]) -> DataFrame:
    """Sum of columns, null if any is."""
    return df.withColumn(out, add_all([q(c) for c in cols]))


def add_ratio(df: DataFrame, out: str, num: str, den: str) -> DataFrame:
    """Quotient of two columns, null on a zero denominator."""
    return df.withColumn(out, ratio(q(num), q(den)))


def fit_min_nonzero(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """Smallest non-zero value per column, from one pass."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return {}
    row = df.agg(*[F.min(F.when(q(c) != 0, q(c))).cast("double").alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return {c: row[f"m{i}"] for i, c in enumerate(cols)}


def log_transform(
    df: DataFrame, cols: Sequence[str], zero: str = "zero", minima: Mapping[str, float | None] | None = None
) -> DataFrame:
    """Add ``log_<c>``. ``zero='zero'`` maps 0 to 0 and keeps the source; ``zero='min'`` maps 0 to the
    log of the column's smallest non-zero value and drops the source. Below zero gives null."""
    cols = [c for c in cols if c in df.columns]
    if zero == "zero":
        return df.withColumns({f"log_{c}": ln_or(q(c).cast("double"), F.lit(0.0)) for c in cols})
    if minima is None:
        minima = fit_min_nonzero(df, cols)
    at = {c: F.ln(F.lit(m)) if (m := minima[c]) is not None and m > 0 else F.lit(None).cast("double") for c in cols}
    return df.withColumns({f"log_{c}": ln_or(q(c).cast("double"), at[c]) for c in cols}).drop(*cols)


def split_xy(df: DataFrame, response: str, split: str, drop: Sequence[str] = ("split",)) -> tuple[DataFrame, DataFrame]:
    """Features and response of one split; both keep the row key."""
    part = df.filter(q("split") == split)
    return part.drop(response, *drop), part.select("id", q(response))


def build_model_data(variants: Mapping[str, DataFrame], response: str, key: str = "id") -> DataFrame:
    """All dataset variants as one long table ``(dataset, split, id, features MAP, label)``."""
    out = None
    for name, df in variants.items():
        nums = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in (key, response)]
        pairs = [x for c in nums for x in (F.lit(c), q(c).cast("double"))]
        part = df.select(
            F.lit(name).alias("dataset"), "split", q(key), F.create_map(*pairs).alias("features"),
            q(response).alias("label"),
        )
        out = part if out is None else out.unionByName(part)
    return out
