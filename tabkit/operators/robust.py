"""Robust kernel regression by Newton's method, for a whole search at once.

A model is linear in random Fourier features of a Gaussian kernel, under Huber's loss with its own scale. The first scan gives every setting the
moments of its features per fold. Each round is one more scan of the rows: every unfinished fit (a setting and the fold left out) gets the pull of
its residuals and the products of the features of the rows beyond its edge, which taken from those of all rows leave Newton's matrix; the
next weights and scale are solved on the driver. Features of a row are made once a setting. Only sums leave the tasks, whatever the number of rows.

A large table may come with a part of its rows. The part only says where the fits of all rows begin: the first scan of all rows then gives moments
and Newton's matrix at once, few more follow, and a fit is finished by the same test on all rows. Where the part misled, a fit begins as without it.
"""

from __future__ import annotations

from collections.abc import Sequence, Set
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.functions.expr import q, quoted
from tabkit.operators.moments import FEW_LEVELS, Moments, merged_partials, pooled, rest_by_fold
from tabkit.operators.regress import fit_ridge

ROUNDS = 30
CLOSE = 1e-6  # relative change of the fitted values' weights at which a fit is finished
NEAR = 1e-3  # the same for fits of a part of the rows, where others begin
ASTRAY = 0.25  # first change, in scales, and share that a round leaves of the change before, from which a beginning is given up
STEADY = 0.05  # change, in scales, below which the products of the rows beyond the edge are those of the scan before
BLOCK_NUMBERS = 4_000_000  # numbers that the moments of the fits of one scan may hold
CHUNK = 1024
NO_FOLD = -1


def _waves(frequency: np.ndarray, shift: np.ndarray, x: np.ndarray, out: np.ndarray) -> None:
    """A row per wave: scaled cosines by the tangent of half the angle, which numpy has as vector code for doubles and the cosine not."""
    height = np.sqrt(2.0 / len(out))
    np.matmul(frequency, x, out=out)
    out += shift
    np.tan(out, out=out)
    out *= out
    out += 1.0
    np.divide(2 * height, out, out=out)
    out -= height


@dataclass(frozen=True)
class RobustKernel:
    """``gamma`` of the kernel, ``c`` (the inverse of the penalty on squared weights), ``epsilon`` (residuals beyond that many scales count linearly)."""

    gamma: float = 0.1
    c: float = 1.0
    epsilon: float = 1.35
    width: int = 64
    seed: int = 27

    def __post_init__(self):
        if self.epsilon <= 1 or self.c <= 0 or self.gamma < 0:
            raise ValueError(f"epsilon must be above 1, c positive and gamma not negative: {self}")

    def halves(self, d: int) -> tuple[np.ndarray, np.ndarray]:
        """Half the frequencies, a row per wave, and half the shifts."""
        rng = np.random.default_rng(self.seed)
        frequency = rng.normal(0.0, np.sqrt(2 * self.gamma), (d, self.width))
        return np.ascontiguousarray(frequency.T) / 2, rng.uniform(0.0, 2 * np.pi, self.width)[:, None] / 2

    def waves(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((self.width, len(x)))
        _waves(*self.halves(x.shape[1]), x.T, out)
        return out.T

    def fit(self, df: DataFrame, features: Sequence[str], label: str) -> FittedRobust:
        """The fit to all rows without nulls."""
        found = fit_robust(df, features, label, [self])[0, NO_FOLD]
        return FittedRobust(self, tuple(features), found.intercept, tuple(found.coef))


@dataclass(frozen=True)
class FittedRobust:
    """A fitted robust kernel model; rows with a null feature get no prediction."""

    spec: RobustKernel
    features: tuple[str, ...]
    intercept: float
    coef: tuple[float, ...]

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        spec, intercept, coef = self.spec, self.intercept, np.array(self.coef)

        @F.pandas_udf("double")
        def value(x: pd.DataFrame) -> pd.Series:
            m = x.to_numpy(dtype=float)
            return pd.Series(spec.waves(m) @ coef + intercept)

        columns = F.struct(*[q(f).cast("double").alias(f"c{i}") for i, f in enumerate(self.features)])
        whole = F.lit(True)
        for f in self.features:
            whole = whole & q(f).isNotNull()
        return df.withColumn(out, F.when(whole, value(columns)))


@dataclass(frozen=True)
class Fit:
    """Where a fit stands, and its squared error per row of the fold it left out (None without such rows)."""

    intercept: float
    coef: np.ndarray
    scale: float
    error: float | None
    rounds: int


def consistency(epsilon: float) -> float:
    """Mean of a squared standard normal cut at ``epsilon``: makes the scale that of a normal's deviation."""
    normal = NormalDist()
    return (2 * normal.cdf(epsilon) - 1) - 2 * epsilon * normal.pdf(epsilon) + 2 * epsilon**2 * (1 - normal.cdf(epsilon))


def _blocks(batches, d: int, specs: dict[int, RobustKernel], places: Sequence[int]):
    """Per chunk of rows of one part (the place of their fold, or the number of places for other folds) and setting: setting, part, and as rows
    a constant, the waves and the label. The next block takes their room."""
    halves = {i: s.halves(d) for i, s in specs.items()}
    room = np.empty((max(s.width for s in specs.values()) + 2) * CHUNK)
    for pdf in batches:
        x, y, fold = pdf[[f"c{i}" for i in range(d)]].to_numpy(dtype=float), pdf["_y"].to_numpy(dtype=float), pdf["_f"].to_numpy()
        at = np.minimum(np.searchsorted(places, fold), len(places) - 1)
        part = np.where(np.array(places)[at] == fold, at, len(places))
        for k in np.unique(part).tolist():
            own = np.flatnonzero(part == k)
            for start in range(0, len(own), CHUNK):  # so few rows stay in a core's cache
                some = own[start : start + CHUNK]
                columns, labels = np.ascontiguousarray(x[some].T), y[some]
                for i, spec in specs.items():
                    z = room[: (spec.width + 2) * len(some)].reshape(-1, len(some))
                    z[0], z[-1] = 1.0, labels
                    _waves(*halves[i], columns, z[1:-1])
                    yield i, k, z


def _starts(rows: DataFrame, d: int, specs: dict[int, RobustKernel], folds: Sequence[int]) -> dict[tuple[int, int], Moments]:
    """Per setting and fold left out the moments of its features and the label on all other rows: each row is counted once."""
    keys, places = sorted(specs), sorted(folds)
    parts = len(places) + 1  # the last one holds the rows of folds that are never left out

    def run(batches):
        held: dict[int, Moments] = {}
        for i, k, z in _blocks(batches, d, specs, places):
            at, m = keys.index(i) * parts + k, Moments.of(z[1:].T)
            held[at] = held[at] + m if at in held else m
        if held:
            yield pd.DataFrame({"_f": list(held), "g": [m.pack() for m in held.values()]})

    merge = lambda blocks: pooled([Moments.unpack(b) for b in blocks]).pack()
    found = merged_partials(rows.mapInPandas(run, "_f int, g binary"), merge, small=_small(specs))
    return _left_out({(i, k): Moments.unpack(found[n * parts + k]) for n, i in enumerate(keys) for k in range(parts) if n * parts + k in found}, specs, places)


def _left_out(own: dict[tuple[int, int], Moments], specs: dict[int, RobustKernel], places: Sequence[int]) -> dict[tuple[int, int], Moments]:
    """Moments by setting and fold left out, from those by setting and part."""
    out = {}
    for i, spec in specs.items():
        rest = rest_by_fold({k: own.get((i, k), Moments.none(spec.width + 1)) for k in range(len(places) + 1)})
        out |= {(i, f): rest[k] for k, f in enumerate(places)}
    return out


def _small(specs: dict[int, RobustKernel]) -> bool:
    return max(s.width for s in specs.values()) <= FEW_LEVELS


@dataclass(frozen=True)
class Sums:
    """What a scan says of a fit: over its rows within the edge the sum of squared residuals and the products of residuals and
    features (the constant first); over those beyond it their number, the features by sign and their products; over held-out rows count and squares."""

    squares: float
    beyond: float
    count: float
    error: float
    inner: np.ndarray
    signs: np.ndarray
    products: np.ndarray | None

    @staticmethod
    def unpack(raw: np.ndarray, d: int) -> Sums:
        products = raw[2 * d + 4 :].reshape(d, d) if len(raw) > 2 * d + 4 else None
        return Sums(*raw[:4].tolist(), raw[4 : d + 4], raw[d + 4 : 2 * d + 4], products)


def _scan(
    rows: DataFrame, d: int, specs: dict[int, RobustKernel], state: dict[tuple[int, int], Fit], folds: Sequence[int],
    exact: Set[tuple[int, int]], centres: dict[int, np.ndarray] | None = None,
) -> tuple[dict[tuple[int, int], Sums], dict[tuple[int, int], Moments]]:
    """The sums of every unfinished fit. Products of features are summed for rows beyond the edge only, and for the fits ``exact``: those of all
    rows are known. Where ``centres`` near the means are given, they are not, and the moments that ``_starts`` gives come with the sums."""
    keys, places = sorted(state), sorted(folds)
    parts = len(places) + 1
    groups: dict[int, list[int]] = {}
    for at, (i, _) in enumerate(keys):
        groups.setdefault(i, []).append(at)
    asked = {i: specs[i] for i in groups}

    def run(batches):
        weights = {i: np.array([[-state[keys[at]].intercept, *-state[keys[at]].coef, 1.0] for at in ats]) for i, ats in groups.items()}
        edges = {i: np.array([[specs[i].epsilon * state[keys[at]].scale] for at in ats]) for i, ats in groups.items()}
        outside = {i: np.array([[k < len(places) and places[k] == keys[at][1] for at in ats] for k in range(parts)]) for i, ats in groups.items()}
        totals = {i: np.zeros((len(ats), 4)) for i, ats in groups.items()}
        pulls = {i: np.zeros((2, *w.shape)) for i, w in weights.items()}  # products of residuals within the edge with the rows of a block, then of signs
        products = {at: np.zeros((specs[key[0]].width + 1,) * 2) for at, key in enumerate(keys) if key in exact}
        means: dict[int, np.ndarray] = {}
        some = False
        for i, k, z in _blocks(batches, d, asked, places):
            some, out, total = True, outside[i][k], totals[i]
            both = np.empty((2, len(out), z.shape[1]))
            left, signs = both
            np.matmul(weights[i], z, out=left)
            total[out, 2] += z.shape[1]
            total[out, 3] += np.einsum("ij,ij->i", left[out], left[out])
            left[out] = 0.0
            over = np.abs(left) > edges[i]
            over[out] = False
            np.multiply(np.sign(left), over, out=signs)
            left[over] = 0.0
            total[:, 0] += np.einsum("ij,ij->i", left, left)
            total[:, 1] += np.count_nonzero(over, axis=1)
            pulls[i] += both @ z.T
            for j, at in enumerate(groups[i]):
                if at in products and not out[j]:
                    far = z[:-1].compress(over[j], axis=1)
                    products[at] += far @ far.T
            if centres is not None:
                z[1:] -= centres[i][:, None]
                at = len(keys) + i * parts + k
                # the products with the constant are the number of rows and their sums
                means[at] = means.get(at, 0.0) + z @ z.T
        if some:
            blocks = {}
            for i, ats in groups.items():
                for j, at in enumerate(ats):
                    blocks[at] = np.concatenate([totals[i][j], *pulls[i][:, j, :-1], *([products[at].ravel()] if at in products else [])])
            blocks |= means
            yield pd.DataFrame({"_f": list(blocks), "g": [b.tobytes() for b in blocks.values()]})

    merge = lambda blocks: np.sum([np.frombuffer(b) for b in blocks], axis=0).tobytes()
    got = {at: np.frombuffer(raw) for at, raw in merged_partials(rows.mapInPandas(run, "_f int, g binary"), merge, small=_small(specs)).items()}
    own = {}
    for at in [at for at in got if at >= len(keys)]:
        i, k = divmod(at - len(keys), parts)
        raw = got.pop(at).reshape(specs[i].width + 2, -1)
        n, sums = raw[0, 0], raw[0, 1:]
        own[i, k] = Moments(float(n), centres[i] + sums / n, raw[1:, 1:] - np.outer(sums, sums) / n)
    return {keys[at]: Sums.unpack(raw, specs[keys[at][0]].width + 1) for at, raw in got.items()}, _left_out(own, specs, places) if own else {}


def _steps(spec: RobustKernel, fit: Fit, m: Moments, s: Sums, beyond: np.ndarray) -> tuple[tuple[np.ndarray, float], tuple[np.ndarray, float] | None]:
    """Changes of intercept, weights and scale: those of one bounded step, which never go astray, and Newton's (None where there is none).

    Both vanish at the same point only: no residual pulls a weight, and the mean cut square is that of a normal of the scale. The bounded step
    takes the products of all rows, which are above those of any weighting; Newton's takes away those ``beyond`` the edge and moves the scale too.
    """
    theta = np.append(fit.intercept, fit.coef)
    mean = np.append(1.0, m.mean[:-1])
    products = m.n * np.outer(mean, mean)
    products[1:, 1:] += m.c[:-1, :-1]
    penalty = np.diag(np.append(0.0, np.full(len(fit.coef), 1.0 / spec.c)))
    edge = spec.epsilon * fit.scale
    pull = s.inner + edge * s.signs - penalty @ theta
    unit = m.n * consistency(spec.epsilon)
    cut = s.squares + edge**2 * s.beyond
    bounded = np.linalg.solve(products + penalty, pull), float(np.sqrt(cut / unit)) - fit.scale
    n = len(theta)
    whole = np.empty((n + 1, n + 1))
    whole[:n, :n] = products - beyond + penalty
    whole[:n, n], whole[n, :n] = -spec.epsilon * s.signs, 2 * s.inner
    whole[n, n] = 2 * fit.scale * (unit - spec.epsilon**2 * s.beyond)
    try:
        newton = np.linalg.solve(whole, np.append(pull, cut - unit * fit.scale**2))
    except np.linalg.LinAlgError:
        return bounded, None
    good = np.isfinite(newton).all() and fit.scale + newton[n] > 0
    return bounded, (newton[:n], float(newton[n])) if good else None


def _ridge(spec: RobustKernel, m: Moments) -> Fit:
    """The fit without an edge, where fits begin."""
    b, w = fit_ridge(m, 1.0 / spec.c)
    v = np.append(-w, 1.0)
    # no scale yet: the mean square of the first residuals, whose mean is 0
    return Fit(b, w, float(np.sqrt(max(v @ m.c @ v, 0.0) / m.n)), None, 0)


def _rounds(
    rows: DataFrame, d: int, specs: dict[int, RobustKernel], folds: Sequence[int], rounds: int, close: float,
    near: tuple[dict[tuple[int, int], Fit], dict[int, np.ndarray]] | None = None,
) -> tuple[dict[tuple[int, int], Fit], dict[tuple[int, int], Moments]]:
    """Finished fits and the moments of their rows. ``near`` gives fits to begin at, and means of each setting's features and label."""
    if near is None:
        base = {key: m for key, m in _starts(rows, d, specs, folds).items() if m.n > 0}
        state, centres = {key: _ridge(specs[key[0]], m) for key, m in base.items()}, None
    else:
        base, (state, centres) = {}, near
    done: dict[tuple[int, int], Fit] = {}
    beyond: dict[tuple[int, int], np.ndarray] = {}
    best, last, exact = dict.fromkeys(state, np.inf), dict.fromkeys(state, np.inf), set(state)
    begun = set(state) if near is not None else set()
    for step in range(1, rounds + 1):
        if not state:
            break
        following: dict[tuple[int, int], Fit] = {}
        found, moments = _scan(rows, d, specs, state, folds, exact, None if base else centres)
        base, exact = base or {key: m for key, m in moments.items() if m.n > 0}, set()
        for key, sums in found.items():
            if key not in base:
                continue
            before, m, spec = state[key], base[key], specs[key[0]]
            error = float(sums.error / sums.count) if sums.count else None
            still, given = before.scale <= 1e-12 * abs(m.mean[-1]), key in begun
            if step == rounds or (still and not given):
                done[key] = Fit(before.intercept, before.coef, before.scale, error, step)
                continue
            if sums.products is not None:
                beyond[key] = sums.products
            bounded, newton = _steps(spec, before, m, sums, beyond[key])
            size = _size(bounded, m)
            # Newton's step only from a point nearer to rest than all before: bounded steps get there from anywhere
            if newton is not None and size < 0.9 * best[key]:
                change, size = newton, max(size, _size(newton, m))
            else:
                change = bounded
            reached, best[key] = best[key], min(best[key], _size(bounded, m))
            if size <= close * before.scale and not still:
                done[key] = Fit(before.intercept, before.coef, before.scale, error, step)
                continue
            if given and (still or not (size <= ASTRAY * before.scale if step == 1 else best[key] <= ASTRAY * reached)):
                begun.remove(key)
                following[key], best[key] = _ridge(spec, m), np.inf
            else:
                following[key] = Fit(before.intercept + float(change[0][0]), before.coef + change[0][1:], before.scale + change[1], None, step)
            if key not in begun or size > STEADY * before.scale or size > 0.1 * last[key]:
                exact.add(key)
            last[key] = size
        state = following
    return done, base


def fit_robust(
    df: DataFrame, features: Sequence[str], label: str, specs: Sequence[RobustKernel], fold: Column | None = None,
    folds: Sequence[int] = (NO_FOLD,), rounds: int = ROUNDS, part: DataFrame | None = None,
) -> dict[tuple[int, int], Fit]:
    """Fits by ``(number of the setting, fold left out)``; rows with a null label, feature or fold are left out.

    The scale follows the residuals (Huber's second proposal) and starts at their mean square, so where no residual lies beyond ``epsilon``
    scales the fit is the ridge on the same features. Fits that no longer move are not part of further scans; the error of a
    fit on its held-out rows comes with the scan that finds it finished. Fits without rows are missing from the result.
    ``part`` holds some rows of ``df`` and saves scans of the others: fits of all rows begin at its own. It does not matter to where they end.
    """
    def numeric(table: DataFrame) -> DataFrame:
        return table.select(
            *[F.expr(f"CAST({quoted(c)} AS DOUBLE) AS c{i}") for i, c in enumerate(features)], q(label).cast("double").alias("_y"),
            (fold if fold is not None else F.lit(0)).cast("int").alias("_f")).na.drop()

    rows, d = numeric(df), len(features)
    done: dict[tuple[int, int], Fit] = {}
    blocks = len(folds) if part is None else 2 * len(folds) + 1
    numbers = lambda i: (specs[i].width + 2) ** 2 * blocks
    todo = list(range(len(specs)))
    while todo:
        group = [todo.pop(0)]
        while todo and sum(map(numbers, group)) + numbers(todo[0]) <= BLOCK_NUMBERS:
            group.append(todo.pop(0))
        own, near = {i: specs[i] for i in group}, None
        if part is not None:
            fits, base = _rounds(numeric(part), d, own, folds, rounds, NEAR)
            if len(fits) == len(own) * len(set(folds)):
                near = fits, {i: m.mean for (i, _), m in base.items()}
        done |= _rounds(rows, d, own, folds, rounds, CLOSE, near)[0]
    return done


def _size(change: tuple[np.ndarray, float], m: Moments) -> float:
    """The greater of the mean change of fitted values and that of the scale."""
    of_weights, of_scale = change
    spread = of_weights[1:] @ m.c[:-1, :-1] @ of_weights[1:] / m.n
    return max(float(np.sqrt(max(spread, 0.0) + (of_weights[0] + of_weights[1:] @ m.mean[:-1]) ** 2)), abs(of_scale))
