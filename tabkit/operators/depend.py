"""Dependence between columns: entropy distance, correlation, rank tests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.functions.expr import no_nan, normal_tail, q, quoted
from tabkit.operators.moments import add_partials
from tabkit.operators.ordering import ordered_prefix, to_long
from tabkit.session import settle, sized_join, sized_like

DIGIT = 16
CHUNK = 100  # pairs up to which one aggregation takes all sums
CONSTANT = 1e-12  # share of the squares about the mean below which a spread is rounding error


def column_pairs(cols: Sequence[str]) -> list[tuple[str, str]]:
    """Unordered pairs of column names."""
    return list(combinations(cols, 2))


# --- label codes ---------------------------------------------------------------------------------

def _typed(df: DataFrame, c: str):
    """A value as (integer, fraction, text), so that numbers order as numbers and text as text."""
    t = df.schema[c].dataType
    i = q(c).cast("bigint") if isinstance(t, (T.IntegralType, T.BooleanType)) else F.lit(None).cast("bigint")
    d = q(c).cast("double") if isinstance(t, T.FractionalType) else F.lit(None).cast("double")
    s = q(c) if isinstance(t, T.StringType) else F.lit(None).cast("string")
    return i, d, s


def level_codes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Settled table ``(column, i, d, s, n, code)``: 0-based codes in sorted value order."""
    entries = []
    for c in cols:
        i, d, s = _typed(df, c)
        entries.append(F.struct(
            F.lit(c).alias("column"), i.alias("i"), d.alias("d"), s.alias("s"), q(c).isNotNull().alias("_there")
        ))
    levels = (
        df.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*").filter("_there")
        .groupBy("column", "i", "d", "s").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("_one", F.lit(1).cast("bigint"))
    )
    held = ordered_prefix(levels, ["column"], ["i", "d", "s"], "_one", "code")
    return sized_like(held.drop("_one"), held)


def apply_level_codes(df: DataFrame, codes: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace values by their codes; null and unseen values become null."""
    for c in cols:
        t = df.schema[c].dataType
        slot = "s" if isinstance(t, T.StringType) else "d" if isinstance(t, T.FractionalType) else "i"
        # measured on its own: the codes of other columns may be many
        one = codes.filter(q("column") == c).select(q(slot).alias("_k"), q("code").alias("_code"))
        joined = sized_join(df.withColumn("_k", q(c).cast(one.schema["_k"].dataType)), one, "_k", "left")
        df = joined.select(*[q("_code").alias(c) if n == c else q(n) for n in df.columns])
    return df


def label_encode_all(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Every listed column as 0-based codes of its sorted values."""
    return apply_level_codes(df, level_codes(df, cols), cols)


# --- entropy distance ----------------------------------------------------------------------------

def joint_counts(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Cell counts ``(var1, var2, v1, v2, n)`` of all pairs in one pass; rows with a null are left out.

    The partial aggregation collapses cells before the shuffle; bin continuous columns first. A row is paired by
    position in its array of values, so the plan grows with the columns only, and a pair's row holds its two values.
    """
    cols = list(dict.fromkeys(x for p in pairs for x in p))
    at = {c: i for i, c in enumerate(cols)}
    partners: list[list[int]] = [[] for _ in cols]
    for a, b in pairs:
        partners[at[a]].append(at[b])
    lists = ", ".join("array({})".format(", ".join(map(str, p)) or "-1") for p in partners)
    values = F.array(*[F.expr(f"CAST({quoted(c)} AS STRING)") for c in cols])
    cells = (
        df.select(values.alias("_v")).select(F.expr(
            f"inline(flatten(transform(array({lists}), (js, i) -> transform(filter(js, j -> j >= 0 AND _v[i] IS NOT NULL AND _v[j] IS NOT NULL), "
            "j -> named_struct('i', i, 'j', j, 'v1', _v[i], 'v2', _v[j])))))"))
        .groupBy("i", "j", "v1", "v2").agg(F.count(F.lit(1)).alias("n"))
    )
    names = "array({})".format(", ".join("'" + c.replace("\\", "\\\\").replace("'", "\\'") + "'" for c in cols))
    return cells.select(
        F.expr(f"element_at({names}, i + 1)").alias("var1"), F.expr(f"element_at({names}, j + 1)").alias("var2"), "v1", "v2", "n"
    )


def pair_distance(cells: DataFrame) -> DataFrame:
    """Entropy distance ``D`` per pair from its cell counts: 2 - (H(a) + H(b)) / H(a, b)."""
    pair = ["var1", "var2"]
    cells = settle(cells)
    m1 = cells.groupBy(*pair, "v1").agg(F.sum("n").alias("n"))
    m2 = cells.groupBy(*pair, "v2").agg(F.sum("n").alias("n"))

    def spread(part: DataFrame, name: str) -> DataFrame:
        return part.groupBy(*pair).agg(
            F.sum("n").alias("_n"), F.sum(q("n") * F.ln(q("n"))).alias("_s")
        ).select(*pair, (F.ln("_n") - q("_s") / q("_n")).alias("h"), F.lit(name).alias("part"))

    wide = (
        spread(cells, "ab").unionByName(spread(m1, "a")).unionByName(spread(m2, "b"))
        .groupBy(*pair).pivot("part", ["ab", "a", "b"]).agg(F.first("h"))
    )
    # a joint entropy of rounding-error size is zero
    d = F.when(q("ab") > 1e-12, F.lit(2.0) - (q("a") + q("b")) / q("ab"))
    return wide.select(*pair, d.alias("D"))


def dependence_distance(df: DataFrame, a: str, b: str) -> DataFrame:
    """Entropy distance of two columns, one row."""
    return pair_distance(joint_counts(df, [(a, b)]))


def dependence_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Entropy distance of every ordered pair, zero on the diagonal."""
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([(c, c, 0.0) for c in cols], "var1 string, var2 string, D double")
    upper = settle(pair_distance(joint_counts(df, column_pairs(cols))))
    lower = upper.select(q("var2").alias("var1"), q("var1").alias("var2"), "D")
    diagonal = df.sparkSession.createDataFrame([(c, c, 0.0) for c in cols], "var1 string, var2 string, D double")
    return upper.unionByName(lower).unionByName(diagonal)


def rank_pairs_by_dependence(pairs: DataFrame, max_d: float) -> DataFrame:
    """Unordered pairs at most ``max_d`` apart, closest first (the table has one row per pair)."""
    order = Window.partitionBy().orderBy("D", "var1", "var2")
    return (
        pairs.filter((q("var1") < q("var2")) & (q("D") <= max_d))
        .withColumn("rank", F.row_number().over(order).cast("bigint"))
    )


def dependence_with_response(df: DataFrame, response: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Entropy distance of each column from the response."""
    cols = [c for c in (cols or df.columns) if c != response]
    return pair_distance(joint_counts(df, [(c, response) for c in cols])).select(q("var1").alias("variable"), "D")


# --- correlation ---------------------------------------------------------------------------------

def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of each unordered pair over the rows where both are present.

    NaN counts as missing. Sums are taken about the columns' means, from a first pass; a pair in which a column's spread is of
    rounding-error size has no correlation. Few pairs come from one aggregation, many from one scan of matrix products
    per Arrow batch, by the same formula. The result has one row per pair.
    """
    pairs = column_pairs(cols)
    doubles = df.select(*[no_nan(q(c).cast("double")).alias(f"c{i}") for i, c in enumerate(cols)])
    at = {c: i for i, c in enumerate(cols)}
    means = doubles.agg(*[F.expr(f"avg(c{i}) AS c{i}") for i in range(len(cols))]).first() if cols else {}
    centre = [m if (m := means[f"c{i}"]) is not None else 0.0 for i in range(len(cols))]
    if len(pairs) > CHUNK:
        r = _wide_correlations(doubles, np.array(centre))
        rows = [(a, b, None if np.isnan(v := r[at[a], at[b]]) else float(v)) for a, b in pairs]
        return df.sparkSession.createDataFrame(rows, "var1 string, var2 string, r double")
    centred = doubles.select(*[(q(f"c{i}") - F.lit(m)).alias(f"c{i}") for i, m in enumerate(centre)])
    sums = []
    for k, (a, b) in enumerate(pairs):
        x, y = q(f"c{at[a]}"), q(f"c{at[b]}")
        both = x.isNotNull() & y.isNotNull()
        terms = {"n": F.lit(1.0), "x": x, "y": y, "xx": x * x, "yy": y * y, "xy": x * y}
        sums.append(F.struct(
            F.lit(a).alias("var1"), F.lit(b).alias("var2"), *[F.sum(F.when(both, t)).alias(n) for n, t in terms.items()]).alias(f"p{k}"))
    if not sums:
        return df.sparkSession.createDataFrame([], "var1 string, var2 string, r double")
    every = centred.agg(*sums).select(F.inline(F.array(*[f"p{k}" for k in range(len(pairs))])))
    sx, sy = q("xx") - q("x") * q("x") / q("n"), q("yy") - q("y") * q("y") / q("n")
    varies = (sx > CONSTANT * q("xx")) & (sy > CONSTANT * q("yy"))
    return every.select("var1", "var2", F.when(varies, (q("xy") - q("x") * q("y") / q("n")) / F.sqrt(sx * sy)).alias("r"))


def _wide_correlations(doubles: DataFrame, centre: np.ndarray) -> np.ndarray:
    d = len(centre)

    def partial(batches):
        held = None
        for pdf in batches:
            x = pdf.to_numpy(dtype=float) - centre
            here = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x)
            part = np.stack([here.T @ here, x.T @ here, (x * x).T @ here, x.T @ x])
            held = part if held is None else held + part
        if held is not None:
            yield pd.DataFrame({"_f": [0], "g": [held.tobytes()]})

    n, s, ss, xy = add_partials(doubles.mapInPandas(partial, "_f int, g binary"))[0].reshape(4, d, d)
    with np.errstate(divide="ignore", invalid="ignore"):
        cov = xy - s * s.T / n
        spread = ss - s * s / n
        # a spread of rounding-error size is a constant column
        spread[spread <= CONSTANT * ss] = np.nan
        return cov / np.sqrt(spread * spread.T)


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Lower triangle: ``(var1, var2, r, abs_r)``."""
    return correlations(df, cols).withColumn("abs_r", F.abs("r"))


def high_correlations(df: DataFrame, cols: Sequence[str], min_abs: float) -> DataFrame:
    """Correlations blanked where they are weak."""
    return correlations(df, cols).withColumn("r", F.when(F.abs("r") >= min_abs, q("r")))


def rank_pairs_by_correlation(df: DataFrame, cols: Sequence[str], min_abs: float) -> DataFrame:
    """Pairs of at least ``min_abs`` absolute correlation, weakest first (one row per pair)."""
    order = Window.partitionBy().orderBy("abs_corr", "var1", "var2")
    return (
        correlations(df, cols).select("var1", "var2", F.abs("r").alias("abs_corr"))
        .filter(q("abs_corr") >= min_abs)
        .withColumn("rank", F.row_number().over(order).cast("bigint"))
    )


# --- rank tests ----------------------------------------------------------------------------------

def _cells(df: DataFrame, cols: Sequence[str], response: str) -> DataFrame:
    """Settled ``(column, x, y, n)`` counts of each column against the response."""
    rows = df.filter(q(response).isNotNull()).withColumn("_y", q(response).cast("double"))
    return settle(
        to_long(rows, cols, ids=["_y"]).select("column", q("value").alias("x"), q("_y").alias("y"))
        .groupBy("column", "x", "y").agg(F.count(F.lit(1)).alias("n"))
    )


def spearman(df: DataFrame, cols: Sequence[str], response: str) -> DataFrame:
    """Rank correlation of each column with the response: ``(variable, stat, z, p_val)``."""
    cells = _cells(df, cols, response)
    sides = F.array(*[F.struct(F.lit(c).alias("side"), q(c).alias("value")) for c in ("x", "y")])
    margins = (
        cells.select("column", "n", F.explode(sides).alias("_s")).select("column", "_s.*", "n")
        .groupBy("column", "side", "value").agg(F.sum("n").alias("n"))
    )
    held = ordered_prefix(margins, ["column", "side"], ["value"], "n")

    def ranks(side: str) -> DataFrame:
        # measured on its own: the ranks of the response are many, those of few levels are not
        return held.filter(q("side") == side).select(
            "column", q("value").alias(side), (q("before") + (q("n") + 1) / 2).alias(f"r{side}"))

    both = sized_join(sized_join(cells, ranks("x"), ["column", "x"], "inner"), ranks("y"), ["column", "y"], "inner")
    s = both.groupBy("column").agg(
        F.sum(q("n") * q("rx") * q("ry")).alias("xy"), F.sum(q("n") * q("rx") * q("rx")).alias("xx"),
        F.sum(q("n") * q("ry") * q("ry")).alias("yy"), F.sum("n").alias("N"),
    )
    # the mean rank is (N + 1) / 2 on both sides, ties or not
    shift = q("N") * ((q("N") + 1) / 2) * ((q("N") + 1) / 2)
    r = F.try_divide(q("xy") - shift, F.sqrt((q("xx") - shift) * (q("yy") - shift)))
    z = r * F.sqrt(q("N") - 1)
    return s.select(q("column").alias("variable"), r.alias("stat"), z.alias("z"), normal_tail(z).alias("p_val"))


def kendall(df: DataFrame, cols: Sequence[str], response: str) -> DataFrame:
    """Tau-b of each column with the response, corrected for ties: ``(variable, stat, z, p_val)``.

    Pairs of rows are never formed. The column's values become dense positions written in base 16;
    for every digit, rows agreeing on all higher digits are put in response order and running
    counts per digit value give the pairs ordered alike and unlike. An ordinal column of up to
    sixteen levels takes one pass.
    """
    cells = _cells(df, cols, response)
    margin_x = cells.groupBy("column", "x").agg(F.sum("n").alias("n"))
    margin_y = cells.groupBy("column", "y").agg(F.sum("n").alias("n"))
    levels = margin_x.withColumn("_one", F.lit(1).cast("bigint"))
    codes = ordered_prefix(levels, ["column"], ["x"], "_one", "code")
    most = codes.agg(F.max("code")).first()[0] or 0
    coded = sized_like(codes.select("column", "x", "code"), codes)
    placed = sized_join(cells, coded, ["column", "x"], "inner").select("column", "code", "y", "n")
    if most >= DIGIT:
        placed = settle(placed)

    net = None
    level = 0
    while DIGIT ** level <= max(most, 1):
        digit = F.floor(q("code") / F.lit(DIGIT ** level)) % DIGIT
        high = F.floor(q("code") / F.lit(DIGIT ** (level + 1)))
        counted = (
            placed.select("column", high.alias("high"), "y", digit.alias("digit"), "n")
            .groupBy("column", "high", "y")
            .agg(F.array(*[
                F.coalesce(F.sum(F.when(q("digit") == d, q("n"))), F.lit(0)).cast("bigint") for d in range(DIGIT)
            ]).alias("w"))
        )
        held = ordered_prefix(counted, ["column", "high"], ["y"], "w", "c")
        # per digit value: earlier rows below it minus earlier rows above it
        step = held.select("column", q("w").alias("_w"), q("c").alias("_c")).select(
            "column", "_w", "_c", F.aggregate("_c", F.lit(0).cast("bigint"), lambda a, v: a + v).alias("_all")
        )
        score = F.aggregate(
            F.zip_with("_w", "_c", lambda w, c: F.struct(w.alias("w"), c.alias("c"))),
            F.struct(F.lit(0.0).alias("lo"), F.lit(0.0).alias("s")),
            lambda acc, e: F.struct(
                (acc["lo"] + e["c"]).alias("lo"),
                (acc["s"] + e["w"] * (acc["lo"] - (q("_all") - acc["lo"] - e["c"]))).alias("s"),
            ),
            lambda acc: acc["s"],
        )
        part = step.groupBy("column").agg(F.sum(score).alias("s"))
        net = part if net is None else net.unionByName(part)
        level += 1

    def ties(margin: DataFrame, tag: str) -> DataFrame:
        t = q("n").cast("double")
        return margin.groupBy("column").agg(
            F.sum(t * (t - 1) / 2).alias(f"pairs_{tag}"), F.sum(t * (t - 1) * (t - 2)).alias(f"three_{tag}"),
            F.sum(t * (t - 1) * (2 * t + 5)).alias(f"five_{tag}"), F.sum(t).alias(f"n_{tag}"),
        )

    # all tables below hold one row per tested column
    one = (
        net.groupBy("column").agg(F.sum("s").alias("s"))
        .join(ties(margin_x, "x"), "column").join(ties(margin_y, "y"), "column")
    )
    n = q("n_x")
    all_pairs = n * (n - 1) / 2
    stat = F.try_divide(q("s"), F.sqrt((all_pairs - q("pairs_x")) * (all_pairs - q("pairs_y"))))
    m = n * (n - 1)
    var = (
        (m * (2 * n + 5) - q("five_x") - q("five_y")) / 18
        + F.try_divide(2 * q("pairs_x") * q("pairs_y"), m)
        + F.try_divide(q("three_x") * q("three_y"), 9 * m * (n - 2))
    )
    z = F.try_divide(q("s"), F.sqrt(var))
    return one.select(q("column").alias("variable"), stat.alias("stat"), z.alias("z"), normal_tail(z).alias("p_val"))


RANK_TESTS = {"spearman": spearman, "kendall": kendall}


def rank_test(df: DataFrame, cols: Sequence[str], response: str, statistic="spearman") -> DataFrame:
    """A named rank test, or any function ``(df, cols, response) -> (variable, stat, z, p_val)``."""
    test = RANK_TESTS[statistic] if isinstance(statistic, str) else statistic
    return test(df, cols, response)


def rank_by(df: DataFrame, col: str, ties: Sequence[str], ascending: bool = True) -> DataFrame:
    """Add ``<col>_rank``: unique ranks 1..n, ties broken by the given identifying columns."""
    sign = q(col).cast("double") if ascending else -q(col).cast("double")
    keyed = df.withColumn("_o", sign).withColumn("_last", q(col).isNull()).withColumn("_one", F.lit(1).cast("bigint"))
    held = ordered_prefix(keyed, [], ["_last", "_o", *ties], "_one", "_b")
    return held.withColumn(f"{col}_rank", q("_b") + 1).drop("_o", "_last", "_one", "_b")


def compare_rank_tests(tests: Mapping[str, DataFrame]) -> DataFrame:
    """Ranks by p-value of several tests side by side, one row per variable.

    Underflown p-values tie at zero, so the larger absolute z goes first among equals.
    """
    out = None
    for name, test in tests.items():
        # one row per variable of the schema
        order = Window.partitionBy().orderBy("p_val", F.abs("z").desc(), "variable")
        part = test.select(
            "variable", q("stat").alias(name), q("p_val").alias(f"{name}_p_val"),
            F.row_number().over(order).cast("bigint").alias(f"{name}_p_val_rank"),
        )
        out = part if out is None else out.join(part, "variable", "full")
    return out
