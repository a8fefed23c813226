"""Global order without a one-task window: ordered prefixes, exact quantiles, ranks.

``ordered_prefix`` range-partitions the distinct keys, sorts each partition, adds up inside it and
settles the result so that partition membership cannot change; then it adds the weight held by
earlier partitions. One shuffle, no task holding more than its range.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.functions.expr import q, quoted
from tabkit.session import settle, sized_join, sized_like


def ordered_prefix(
    df: DataFrame, by: Sequence[str], keys: Sequence[str], weight: str, out: str = "before"
) -> DataFrame:
    """Add the sum of ``weight`` over the rows of the same ``by`` group with strictly smaller ``keys``.

    Group and keys together must be unique (aggregate first: that also removes hot keys). ``weight``
    is a bigint or an array of bigints of one length. A group may span any number of partitions:
    each partition adds up on its own, and what the earlier partitions hold of its leading group is
    added afterwards from one summary row per partition.
    """
    by = list(by)
    cols = [q(k) for k in [*by, *keys]]
    is_array = isinstance(df.schema[weight].dataType, T.ArrayType)
    sorted_parts = (
        df.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("_part", F.spark_partition_id())
    )
    out_type = T.ArrayType(T.LongType()) if is_array else T.LongType()
    schema = T.StructType([
        *sorted_parts.schema.fields, T.StructField(out, out_type), T.StructField("_lead", T.BooleanType()),
        T.StructField("_pos", T.LongType()),
    ])
    local = settle(sorted_parts.mapInArrow(_running_sums(by, weight, out, is_array), schema))
    # one row per partition
    parts = local.groupBy("_part").agg(
        F.min_by(F.struct(F.lit(0), *[q(b) for b in by]), "_pos").alias("first"),
        F.max_by(F.struct(F.lit(0), *[q(b) for b in by]), "_pos").alias("last"),
        F.max_by(q(out), "_pos").alias("last_before"), F.max_by(q(weight), "_pos").alias("last_weight"),
        F.min("_lead").alias("one_group"),
    ).collect()
    carried: dict[int, list[int] | int] = {}
    group, total = None, None
    for r in sorted(parts, key=lambda r: r["_part"]):
        tail = np.asarray(r["last_before"]) + np.asarray(r["last_weight"])
        start = total if group is not None and group == r["first"] else np.zeros_like(tail)
        carried[r["_part"]] = start.tolist()
        total = tail + start if r["one_group"] else tail
        group = r["last"]
    result = local
    if any(np.any(c) for c in carried.values()):
        held = F.array(*[_long_literal(carried.get(i, carried[min(carried)])) for i in range(max(carried) + 1)])
        start = F.element_at(held, q("_part") + 1)
        moved = F.zip_with(q(out), start, lambda a, b: a + b) if is_array else q(out) + start
        result = local.withColumn(out, F.when(q("_lead"), moved).otherwise(q(out)))
    return sized_like(result.drop("_part", "_lead", "_pos"), local)


def _long_literal(value):
    if isinstance(value, list):
        return F.array(*[F.lit(int(v)).cast("bigint") for v in value])
    return F.lit(int(value)).cast("bigint")


def _running_sums(by: list[str], weight: str, out: str, is_array: bool):
    """Running sums inside one sorted partition, restarted where the group changes."""

    def run(batches):
        total, base, last, at = None, None, None, 0
        lead = True
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            held = batch.column(batch.schema.get_field_index(weight))
            w = np.asarray(held.flatten()).reshape(n, -1) if is_array else np.asarray(held).reshape(n, 1)
            if total is None:
                total = base = np.zeros((1, w.shape[1]), dtype=np.int64)
            before = np.cumsum(w, axis=0) - w + total
            changed = np.zeros(n, dtype=bool)
            now = []
            for b in by:
                c = batch.column(batch.schema.get_field_index(b))
                if n > 1:
                    a, z = c.slice(0, n - 1), c.slice(1)
                    same = pc.equal(a, z).fill_null(False)
                    both = pc.and_(a.is_null(), z.is_null())
                    changed[1:] |= ~np.asarray(pc.or_(same, both))
                now.append((c[0].as_py(), c[n - 1].as_py()))
            if last is not None and [x for x, _ in now] != last:
                changed[0] = True
            last = [x for _, x in now]
            # index of the row that opened each row's group; 0 stands for the group carried in
            opened = np.maximum.accumulate(np.where(changed, np.arange(1, n + 1), 0))
            bases = np.concatenate([base, before])[opened]
            leads = (opened == 0) & lead
            result = before - bases
            total, base = before[-1:] + w[-1:], bases[-1:]
            lead = bool(leads[-1])
            added = pa.array(list(result), pa.list_(pa.int64())) if is_array else pa.array(result[:, 0])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, added, pa.array(leads), pa.array(np.arange(at, at + n))],
                names=[*batch.schema.names, out, "_lead", "_pos"],
            )
            at += n

    return run


def rank_rows(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """Unique 1-based rank of every row by ``order``, which must identify rows; nulls rank first."""
    held = ordered_prefix(df.withColumn("_one", F.lit(1).cast("bigint")), [], order, "_one", "_b")
    return held.withColumn(out, q("_b") + 1).drop("_one", "_b")


def to_long(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = (), as_type: str = "double") -> DataFrame:
    """Wide to long ``(ids, column, value)`` without nulls."""
    typed = df.select(*[quoted(i) for i in ids], *[
        F.expr(f"CAST({quoted(c)} AS {as_type}) AS {quoted(c)}") for c in cols])
    return typed.unpivot(
        [quoted(i) for i in ids], [quoted(c) for c in cols], "column", "value"
    ).filter("value is not null")


def quantiles(
    long: DataFrame, by: Sequence[str], value: str, probs: Sequence[float], accuracy: int = 1000
) -> DataFrame:
    """Exact interpolated quantiles per group of at least one column.

    Rows ``(by, prob, quantile, n, low, high)`` with the group's size and extremes.

    A sketch brackets every target rank; only the values inside the brackets, a share of about
    ``4 / accuracy`` of the rows, are shuffled and ordered. Should a bracket miss, the whole range
    of that run is ordered instead, so that the result is exact either way.
    """
    by = list(by)
    long = long.filter(q(value).isNotNull()).select(*[q(b) for b in by], q(value).cast("double").alias("_v"))
    eps = 2.0 / accuracy
    bounds = sorted({max(0.0, p - eps) for p in probs} | {min(1.0, p + eps) for p in probs})
    sketch = long.groupBy(*[q(b) for b in by]).agg(
        F.percentile_approx("_v", bounds, accuracy).alias("_s"),
        F.min("_v").alias("_min"), F.max("_v").alias("_max"), F.count("_v").alias("_n"),
    )
    # the rank error of a small group is not small against its bracket: it is ordered whole
    few = q("_n") < 4 * accuracy
    wanted = F.array(*[
        F.struct(
            F.lit(float(p)).alias("prob"),
            F.when(few | F.lit(p - eps <= 0), q("_min")).otherwise(q("_s")[bounds.index(max(0.0, p - eps))]).alias("_lo"),
            F.when(few | F.lit(p + eps >= 1), q("_max")).otherwise(q("_s")[bounds.index(min(1.0, p + eps))]).alias("_hi"),
            ((q("_n") - 1) * F.lit(float(p))).alias("_at"),
        )
        for p in probs
    ])
    bracket = settle(
        sketch.select(*[q(b) for b in by], "_n", "_min", "_max", F.explode(wanted).alias("_w"))
        .select(*[q(b) for b in by], "_n", "_min", "_max", "_w.*")
    )
    got, missed = _pick(long, bracket, by)
    if missed:
        whole = settle(bracket.withColumn("_lo", q("_min")).withColumn("_hi", q("_max")))
        got, _ = _pick(long, whole, by)
    return got


def _pick(long: DataFrame, bracket: DataFrame, by: list[str]):
    group = [*by, "prob"]
    counted = (
        sized_join(long, bracket, by, "inner").filter("_v <= _hi")
        .select(*[q(g) for g in group], F.when(q("_v") >= q("_lo"), q("_v")).alias("_v"))
        .groupBy(*[q(g) for g in group], "_v").agg(F.count(F.lit(1)).alias("n"))
    )
    held = ordered_prefix(counted, group, ["_v"], "n")
    covers0 = (F.floor("_at") >= q("before")) & (F.floor("_at") < q("before") + q("n"))
    covers1 = (F.ceil("_at") >= q("before")) & (F.ceil("_at") < q("before") + q("n"))
    found = settle(
        sized_join(held, sized_like(bracket.select(*[q(g) for g in group], "_at", "_n", "_min", "_max"), bracket), group, "inner")
        .groupBy(*[q(g) for g in group])
        .agg(
            F.max(F.when(covers0, q("_v"))).alias("_a"), F.max(F.when(covers1, q("_v"))).alias("_b"),
            *[F.max(c).alias(c) for c in ("_at", "_n", "_min", "_max")],
        )
    )
    missed = found.filter("_a is null or _b is null").limit(1).count() > 0
    value = q("_a") + (q("_b") - q("_a")) * (q("_at") - F.floor("_at"))
    return found.select(
        *[q(g) for g in group], value.alias("quantile"), q("_n").alias("n"), q("_min").alias("low"), q("_max").alias("high")
    ), missed


def column_quantiles(df: DataFrame, cols: Sequence[str], prob: float = 0.5) -> dict[str, float]:
    """One exact quantile per column as driver scalars (one number per column)."""
    if not cols:
        return {}
    rows = quantiles(to_long(df, cols), ["column"], "value", [prob]).collect()
    return {r["column"]: r["quantile"] for r in rows}


def column_modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str]:
    """Most frequent text value per column, the smallest on ties (one value per column)."""
    if not cols:
        return {}
    counted = to_long(df, cols, as_type="string").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("column").agg(F.min_by("value", F.struct(-q("n"), q("value"))).alias("mode"))
    return {r["column"]: r["mode"] for r in best.collect()}
