"""Filling missing values: by constants, by a classifier, by chained regressions with donors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.functions.expr import poisson_one, q
from tabkit.operators.encode import apply_min_max, fit_min_max, level_lists, one_hot
from tabkit.operators.moments import Moments, moments_by_weight
from tabkit.operators.ordering import column_modes, column_quantiles
from tabkit.operators.profile import null_counts
from tabkit.operators.regress import LinearFit, fit_ridge
from tabkit.operators.roles import Roles
from tabkit.session import discard, settle, sized_join, store


def apply_fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls by one value per column, keeping the column types (halves to even for integers)."""
    whole = {f.name for f in df.schema if isinstance(f.dataType, T.IntegralType)}
    values = {c: round(v) if c in whole else v for c, v in values.items() if v is not None}
    return df.select(*[
        F.coalesce(q(c), F.lit(values[c]).cast(df.schema[c].dataType)).alias(c) if c in values else q(c)
        for c in df.columns
    ])


def fit_few(
    df: DataFrame, roles: Roles, max_cat: int = 4, max_ord: int = 2, max_quant: int = 1
) -> dict[str, object]:
    """Fill values of the columns with few nulls: mode for categorical, median for the others."""
    nulls = {r["column"]: r["nulls"] for r in null_counts(df).collect()}
    cats = [c for c in roles.cat if 0 < nulls.get(c, 0) <= max_cat]
    nums = [c for c in roles.ord if 0 < nulls.get(c, 0) <= max_ord]
    nums += [c for c in roles.quant if 0 < nulls.get(c, 0) <= max_quant]
    return {**column_modes(df, cats), **column_quantiles(df, nums)}


def impute_few(df: DataFrame, roles: Roles, max_cat: int = 4, max_ord: int = 2, max_quant: int = 1) -> DataFrame:
    """Fill the columns that have at most a given number of nulls."""
    return apply_fill(df, fit_few(df, roles, max_cat, max_ord, max_quant))


def complete_case_medians(df: DataFrame, cols: Sequence[str], over: Sequence[str] | None = None) -> dict[str, float]:
    """Medians over the rows without any null in ``over`` (default: all columns)."""
    return column_quantiles(df.na.drop(subset=list(over) if over is not None else None), cols)


def impute_categorical(
    df: DataFrame, col: str, roles: Roles, response: str, classifier=None
) -> DataFrame:
    """Fill the nulls of a categorical column by a classifier on all other columns but the response.

    Fitted on complete rows; for prediction, other missing numbers take complete-case medians.
    Observed cells stay as they are.
    """
    roles = roles.within(df)
    cats = [c for c in roles.cat if c not in (col, response)]
    nums = [c for c in (*roles.ord, *roles.quant) if c not in (col, response)]
    names = [*cats, *nums]
    levels = level_lists(df, cats)
    fills = complete_case_medians(df, nums, [*nums, col])
    ready = apply_fill(df.withColumns({f"_n_{c}": q(c).cast("double") for c in nums}),
                       {f"_n_{c}": v for c, v in fills.items()})
    flags = [f"{c}_{v}" for c in cats for v in levels[c]]
    shown = one_hot(ready.withColumns({f"_c_{c}": q(c) for c in cats}), [f"_c_{c}" for c in cats],
                    {f"_c_{c}": levels[c] for c in cats})
    inputs = [f"_c_{f}" for f in flags] + [f"_n_{c}" for c in nums]
    renamed = {n: f"_x{i}" for i, n in enumerate(inputs)}
    shown = shown.withColumnsRenamed(renamed)
    xs = list(renamed.values())
    scaled = apply_min_max(shown, fit_min_max(shown, xs))
    est = classifier if classifier is not None else RandomForestClassifier(numTrees=20, maxDepth=8, seed=27)
    est = est.copy({est.featuresCol: "_x", est.labelCol: "_y", est.predictionCol: "_p"})
    stages = [
        StringIndexer(inputCol=col, outputCol="_y", stringOrderType="alphabetAsc", handleInvalid="keep"),
        VectorAssembler(inputCols=xs, outputCol="_x"),
    ]
    prep = Pipeline(stages=stages).fit(scaled.filter(q(col).isNotNull()))
    complete = prep.transform(scaled.na.drop(subset=[*[n for n in names if n in nums], col])).select("_x", "_y")
    fitted = est.fit(complete)
    named = IndexToString(inputCol="_p", outputCol="_level", labels=prep.stages[0].labels)
    out = named.transform(fitted.transform(prep.transform(scaled)))
    return out.select(*[F.coalesce(q(col), q("_level")).alias(col) if c == col else q(c) for c in df.columns])


def impute_categoricals(df: DataFrame, roles: Roles, response: str, classifier=None) -> DataFrame:
    """Fill every categorical column with nulls, one after another."""
    nulls = {r["column"] for r in null_counts(df).collect()}
    for col in [c for c in roles.within(df).cat if c in nulls and c != response]:
        df = store(impute_categorical(df, col, roles, response, classifier))
    return df


def group_mode_fill(df: DataFrame, col: str, by: str) -> DataFrame:
    """Baseline classifier: the most frequent level within each group, smallest on ties."""
    modes = settle(
        df.filter(q(col).isNotNull()).groupBy(q(by), q(col)).agg(F.count(F.lit(1)).alias("n"))
        .groupBy(q(by)).agg(F.min_by(q(col), F.struct(-q("n"), q(col))).alias("_m"))
    )
    joined = sized_join(df, modes, by, "left")
    return joined.select(*[F.coalesce(q(c), q("_m")).alias(c) if c == col else q(c) for c in df.columns])


# --- chained regressions with donor matching -----------------------------------------------------


PER_BIN = 50_000  # donors that a bin near the mean should hold
SPREADS = 8  # bins reach this many spreads to either side; the outermost take the rest
GAP_BLOCK = 20_000  # questions that one task answers for one bin


def _bin(pred: Column, centre: float, width: float, half: int) -> Column:
    return F.greatest(F.least(F.floor((pred - F.lit(centre)) / F.lit(width)), F.lit(half)), F.lit(-half)).cast("int")


def _asked_bins(counts: pd.DataFrame, k: int) -> pd.DataFrame:
    """``bin, owner, side``: which donors' bins every asked bin needs.

    A bin with gaps needs its own donors (side 0) and, to either side, bins until they hold ``k`` donors; of those the nearest
    ``k`` of each are enough (side -1: the bin lies below, 1: above).
    """
    held = counts[counts["donors"] > 0].sort_values("bin")
    bins, n = held["bin"].to_numpy(), np.concatenate([[0], np.cumsum(held["donors"].to_numpy())])
    asked = counts.loc[counts["gaps"] > 0, "bin"].to_numpy()
    at, after = np.searchsorted(bins, asked), np.searchsorted(bins, asked, side="right")
    low = np.maximum(np.searchsorted(n, n[at] - k, side="right") - 1, 0)
    high = np.minimum(np.searchsorted(n, n[after] + k), len(bins))
    rows = [(int(bins[i]), int(o), int(np.sign(i - a) if i < a else i >= b)) for o, l, h, a, b in zip(asked, low, high, at, after) for i in range(l, h)]
    return pd.DataFrame(rows, columns=["bin", "owner", "side"]).astype({"bin": "int32", "owner": "int32", "side": "int32"})


def _in_order(donors: pd.DataFrame) -> pd.DataFrame:
    """By prediction, then key."""
    if donors["_d"].dtype.kind in "iuf":
        return donors.take(np.lexsort((donors["_d"].to_numpy(), donors["_dp"].to_numpy())))
    return donors.sort_values(["_dp", "_d"])


def _places(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many equal values stand before and after each."""
    new = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)])
    sizes = np.diff(np.append(new, len(ordered)))
    before = np.arange(len(ordered)) - np.repeat(new, sizes)
    return before, np.repeat(sizes, sizes) - 1 - before


def _repeated(times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each place as often as ``times`` says, and its number among those of its place."""
    at = np.repeat(np.arange(len(times)), times)
    return at, np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)


def match_donors(
    donors: DataFrame, missing: DataFrame, key: str, donors_per_row: int, pick, spread: tuple[float, float, float] | None = None
) -> DataFrame:
    """``missing`` with ``_drawn``: for every row one value drawn among its nearest donors by predicted mean.

    ``donors (key, pred, value)``; ``missing (key, pred, ...)``. Nearest are, of the ``k`` donors below a row's prediction and the ``k``
    from it on (in order of prediction, then key), the ``k`` at the least distance, ties by key. ``pick`` maps the key column to an
    integer choosing among them. Rows without a prediction, and all rows where there is no donor, are left out.

    Predictions fall into bins whose counts are one small aggregation; from them follows which bins a gap can need. Only those are
    shuffled, of neighbouring bins only the ``k`` at the edge, of donors predicted alike only the first and last ``k`` keys of each batch. No order
    of all donors is made. Bins with many gaps are cut into blocks. ``spread`` gives mean, deviation and number of predictions where known.
    """
    k, spark = donors_per_row, donors.sparkSession
    # a donor without a prediction is near nobody
    donors = donors.filter(q("pred").isNotNull() & ~F.isnan("pred")).select(q(key).alias("_d"), q("pred").alias("_dp"), q("value"))
    missing = missing.filter(q("pred").isNotNull() & ~F.isnan("pred"))
    if spread is None:
        got = donors.agg(F.avg("_dp"), F.stddev_pop("_dp"), F.count("_dp")).first()
        spread = (got[0] or 0.0, got[1] or 0.0, got[2])
    centre, deviation, n = spread
    per_spread = int(np.clip(n // PER_BIN, 4, 1 << 15))
    width, half = deviation / per_spread or 1.0, SPREADS * per_spread
    donors = donors.withColumn("_bin", _bin(q("_dp"), centre, width, half))
    missing = missing.withColumn("_bin", _bin(q("pred"), centre, width, half)).withColumn("_pick", pick(q(key)).cast("bigint"))
    # at most two numbers per bin
    counts = donors.select("_bin", F.lit(1).alias("d"), F.lit(0).alias("g")).unionAll(missing.select("_bin", F.lit(0), F.lit(1)))
    counts = pd.DataFrame(
        [tuple(r) for r in counts.groupBy("_bin").agg(F.sum("d"), F.sum("g")).collect()], columns=["bin", "donors", "gaps"])
    asked = _asked_bins(counts, k)
    blocks = (-(-counts.set_index("bin")["gaps"] // GAP_BLOCK)).clip(lower=1)
    asked["blocks"] = asked["owner"].map(blocks).astype("int64")
    sides = [asked[asked["side"] == side].sort_values("bin") for side in (0, -1, 1)]
    served = [tuple(w[c].to_numpy() for c in ("bin", "owner", "blocks")) for w in sides]
    held = spark.sparkContext.broadcast((served, np.unique(asked["bin"].to_numpy()), blocks.astype("int64")))

    def serve(batches):
        wanted, bins, _ = held.value
        for pdf in batches:
            pdf = _in_order(pdf[np.isin(pdf["_bin"].to_numpy(), bins)])
            own = pdf["_bin"].to_numpy()  # bins follow the order of predictions
            above, below = _places(own)
            ends = np.minimum(*_places(pdf["_dp"].to_numpy())) < k
            donor = pdf[["_d", "_dp", "value"]]
            for (bin_, owner, many), keep in zip(wanted, (ends, below < k, above < k)):
                rows = np.flatnonzero(keep)
                first, end = np.searchsorted(bin_, own[rows]), np.searchsorted(bin_, own[rows], side="right")
                at, nth = _repeated(end - first)
                rows, ask_at = rows[at], first[at] + nth
                at, block = _repeated(many[ask_at])
                yield donor.take(rows[at]).assign(owner=owner[ask_at][at], _block=block.astype("int32"))[["owner", "_block", "_d", "_dp", "value"]]

    def ask(batches):
        for pdf in batches:
            many = held.value[2].reindex(pdf["_bin"]).to_numpy()
            yield pdf.assign(_block=(np.arange(len(pdf)) % many).astype("int32"))

    types = {f.name: f.dataType.simpleString() for f in donors.schema}
    there = donors.mapInPandas(serve, f"owner int, _block int, _d {types['_d']}, _dp double, value {types['value']}")
    fields = T.StructType([*missing.schema.fields, T.StructField("_block", T.IntegerType())])
    asking = missing.mapInPandas(ask, fields)
    out = T.StructType([f for f in missing.schema.fields if f.name not in ("_bin", "_pick")] + [T.StructField("_drawn", donors.schema["value"].dataType)])

    def match(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame(columns=out.names)
        b = _in_order(b)
        keys = b["_d"].to_numpy() if b["_d"].dtype.kind in "iuf" else b["_d"].rank(method="first").to_numpy()
        p, order, values = b["_dp"].to_numpy(), keys, b["value"].to_numpy()
        points, which = np.unique(a["pred"].to_numpy(), return_inverse=True)
        nearest, size = np.zeros((len(points), k), np.int64), np.zeros(len(points), np.int64)
        for at in range(0, len(points), 4096):  # rows predicted alike ask for the same donors
            part = points[at : at + 4096]
            spots = np.searchsorted(p, part)[:, None] + np.arange(-k, k)
            valid = (spots >= 0) & (spots < len(p))
            spots = np.clip(spots, 0, len(p) - 1)
            gap = np.where(valid, np.abs(part[:, None] - p[spots]), np.inf)
            best = np.lexsort((order[spots], gap), axis=1)[:, :k]
            nearest[at : at + 4096] = np.take_along_axis(spots, best, 1)
            size[at : at + 4096] = np.minimum(valid.sum(1), k)
        chosen = nearest[which, a["_pick"].to_numpy() % size[which]]
        return a.drop(columns=["_bin", "_pick", "_block"]).assign(_drawn=values[chosen])[out.names]

    return asking.groupBy(q("_bin"), q("_block")).cogroup(there.groupBy(q("owner"), q("_block"))).applyInPandas(match, out)


def impute_chained(
    df: DataFrame, key: str, targets: Sequence[str], predictors: Sequence[str], iterations: int = 6,
    donors: int = 20, seed: int = 1, bootstrap: bool = True,
) -> DataFrame:
    """Fill numeric columns by chained regressions with predictive mean matching.

    Every target starts at the observed value nearest its mean. In each round each target is
    regressed on all other columns (bootstrap weights by a hash of the key), and its missing cells
    take the value of a donor with a similar prediction. Rows without gaps never change: their moments under the weights of every
    step come from one scan, a step adds those of the incomplete rows and rewrites only these. Each step is a stored table, and the
    one before it is deleted. Predictors that are not targets must be complete.
    """
    targets = list(targets)
    inputs = list(dict.fromkeys([*targets, *predictors]))
    nulls = {r["column"]: r["nulls"] for r in null_counts(df.select(*[q(t) for t in targets])).collect()}
    order = sorted((t for t in targets if t in nulls), key=lambda t: (nulls[t], t))
    if not order:
        return df
    rest = [c for c in inputs if c not in targets]
    empty = [r["column"] for r in null_counts(df.select(*[q(c) for c in rest])).collect() if r["nulls"]] if rest else []
    if empty:
        raise ValueError("predictors hold nulls; fill them first or make them targets: " + ", ".join(empty))
    means = df.agg(*[F.avg(q(t)).alias(t) for t in order]).first()
    starts = df.agg(*[
        # a null order is passed over; a struct of nulls would come first
        F.min_by(q(t).cast("double"), F.when(q(t).isNotNull(), F.struct(F.abs(q(t) - F.lit(means[t])), q(t)))).alias(t)
        for t in order
    ]).first().asDict()

    gap = None
    for t in order:
        gap = q(t).isNull() if gap is None else gap | q(t).isNull()
    base = df.select(q(key), *[q(c).cast("double").alias(c) for c in inputs])
    whole = store(base.filter(~gap))
    holes = store(apply_fill(
        base.filter(gap).withColumns({f"_was_{t}": q(t).isNull() for t in order}), starts))

    steps = [(t, seed * 7919 + round_ * 104729 + j * 1299709) for round_ in range(iterations) for j, t in enumerate(order)]
    weigh = lambda salt: poisson_one(key, salt) if bootstrap else F.lit(1)
    none = Moments.none(len(inputs))
    weightings = [weigh(salt) for _, salt in steps] if bootstrap else [F.lit(1)]
    of_whole = moments_by_weight(whole, inputs, weightings)
    for i, (t, salt) in enumerate(steps):
        xs = [c for c in inputs if c != t]
        seen = holes.filter(~q(f"_was_{t}"))
        of_seen = moments_by_weight(seen, inputs, [weigh(salt)]).get((0, 0), none)
        m = (of_whole.get((0, i if bootstrap else 0), none) + of_seen).columns([inputs.index(c) for c in [*xs, t]])
        if not m.n:
            continue
        b, w = fit_ridge(m, 1e-9 * max(m.n, 1.0))
        # rounding makes the order of donors independent of the summation order
        pred = F.round(LinearFit(tuple(xs), b, tuple(w)).column(), 9).alias("pred")
        givers = whole.select(q(key), pred, q(t).alias("value")).unionAll(seen.select(q(key), pred, q(t)))
        filled = match_donors(
            givers, holes.filter(q(f"_was_{t}")).select(*holes.columns, pred), key, donors,
            lambda c, s=salt: F.pmod(F.xxhash64(c, F.lit(s + 1)), F.lit(2 ** 31)),
            (float(b + w @ m.mean[:-1]), float(np.sqrt(max(w @ m.c[:-1, :-1] @ w, 0.0) / m.n)), m.n))
        filled = filled.select(*[q("_drawn" if c == t else c).alias(c) for c in holes.columns])
        now = store(seen.unionAll(filled))
        discard(holes)
        holes = now
    discard(whole)
    filled = holes.select(q(key), *[q(t).alias(f"_fill_{t}") for t in order])
    joined = df.join(filled, key, "left")
    return joined.select(*[
        F.coalesce(q(c), q(f"_fill_{c}").cast(df.schema[c].dataType)).alias(c) if c in order else q(c) for c in df.columns
    ])
