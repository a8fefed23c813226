"""Whole flows, plan shapes and streaming use."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tabkit.functions.expr import fold_of, q
from tabkit.operators.encode import apply_min_max, encode_ordinals, fit_min_max
from tabkit.operators.evaluate import compare_models
from tabkit.operators.features import flag_nonzero, log_transform, recode
from tabkit.operators.encode import model_matrix
from tabkit.operators.profile import null_counts
from tabkit.operators.regress import Linear
from tabkit.operators.roles import infer_roles
from tabkit.plans import housing
from tabkit.plans.modelling import fit_all

FREE_LEVELS = {"MSSubClass": ["20", "60", "150"], "RoofMatl": ["CompShg", "WdShake", "Metal"], "MasVnrType": ["None", "BrkFace", "BrkComm"]}


@pytest.fixture(scope="module")
def raw(spark):
    """A made-up table with the housing columns."""
    rng = np.random.default_rng(11)
    n = 240
    size = rng.normal(size=n)
    pdf = pd.DataFrame({"id": np.arange(1, n + 1), "split": np.where(np.arange(n) % 3 == 2, "test", "train")})
    for c in housing.CAT:
        pdf[c] = rng.choice(FREE_LEVELS.get(c, ["aa", "bb"]), n)
    for c in housing.ORD:
        codes = housing.ORDINAL_CODES.get(c)
        pdf[c] = rng.choice([k for k in codes if k is not None], n) if codes else rng.integers(0, 9, n)
    pdf["Functional"] = rng.choice(["Typ", "Min1", "Min2"], n)
    for c in housing.QUANT:
        pdf[c] = np.round(np.abs(rng.normal(50, 20, n)), 1)
    pdf["GrLivArea"] = np.round(1500 + 400 * size)
    pdf["LotFrontage"] = np.round(70 + 10 * size)
    pdf["PoolArea"] = 0.0
    pdf["SalePrice"] = np.round(np.exp(12 + 0.4 * size + rng.normal(scale=0.05, size=n)))
    for c, step in (("LotFrontage", 6), ("MasVnrArea", 20), ("Alley", 2), ("MiscFeature", 3), ("GarageType", 17), ("Electrical", 200),
                    ("Functional", 150), ("PoolQC", 4), ("BsmtCond", 9)):
        pdf[c] = pdf[c].astype(object).where(pdf["id"] % step != 0, None)
    pdf.loc[4, ["OverallQual", "SalePrice"]] = [3, 250000.0]
    pdf.loc[pdf["split"] == "test", "SalePrice"] = None
    pdf[list(housing.QUANT)] = pdf[list(housing.QUANT)].astype(float)
    rows = [tuple(None if pd.isna(v) else v.item() if hasattr(v, "item") else v for v in r) for r in pdf.itertuples(index=False)]
    text = {*housing.CAT, *housing.ORDINAL_CODES, "Functional", "split"}
    kind = {c: "string" if c in text else "double" if c in housing.QUANT else "bigint" for c in pdf.columns}
    return spark.createDataFrame(rows, ", ".join(f"`{c}` {t}" for c, t in kind.items())).cache()


def test_housing_flow(raw):
    clean = housing.prepare(raw, iterations=1, donors=3).cache()
    assert "Alley" not in clean.columns and "MiscFeature" not in clean.columns and "SalePrice" in clean.columns
    # the encoded pool quality has a code for a missing value, so it is not sparse
    assert dict(clean.dtypes)["PoolQC"] == "bigint" and dict(clean.dtypes)["MSSubClass"] == "string"
    assert {r["column"] for r in null_counts(clean).collect()} == {"SalePrice"}
    assert clean.filter("OverallQual < 5 and SalePrice > 200000").count() == 0
    observed = {r["LotFrontage"] for r in raw.select("LotFrontage").distinct().collect()}
    assert {r["LotFrontage"] for r in clean.select("LotFrontage").distinct().collect()} <= observed

    made = housing.variants(clean)
    assert list(made) == ["clean", "drop", "clean_edit", "drop_edit"]
    assert all("Utilities" not in df.columns and "log_SalePrice" in df.columns for df in made.values())
    edited = made["clean_edit"]
    assert {"Bath", "BsmtBath", "HasPool", "HasPorch", "log_OverallArea", "log_LotRatio", "AvgCond"} <= set(edited.columns)
    assert "FullBath" not in edited.columns and "GarageArea" in edited.columns
    assert {"HasPool", "Has2ndFlr"} <= set(made["drop_edit"].columns) and "PoolQC" not in made["drop_edit"].columns
    assert edited.filter("RoofMatl in ('WdShake', 'Metal') or MSSubClass = '150'").count() == 0

    variants = {}
    for name in ("clean", "drop_edit"):
        df = made[name]
        roles = infer_roles(df, "log_SalePrice", ("split", "id"))
        matrix, features = model_matrix(df, roles, "log_SalePrice")
        variants[name] = (matrix.filter("split = 'train'").withColumn("fold", fold_of(q("id"), 5)).cache(), features)
    scores = compare_models(*fit_all(variants, {"ridge": Linear(), "pls": Linear("pls", {"n_components": 2})}, "log_SalePrice", "fold")).collect()
    assert len(scores) == 4 and all(r["train_rmse"] < r["cv_rmse"] < 0.5 for r in scores)


BIG = ["b4_drop_matching", "b5_drop_first_match", "c1_null_counts", "c7_value_counts", "c8_rare_levels", "c15_group_distribution",
       "d1_label_encode_all", "d3_dependence_matrix", "d6_correlation_matrix", "d9_rank_test_spearman", "d10_rank_test_kendall", "d11_rank_by",
       "e3_label_encode_ordinals", "e12_model_matrix", "f9_log_min", "g5_set_ops", "i1_moments", "i13_cv_rmse", "j6_normalise_weights", "j7_vote"]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BIG)
def test_no_single_task_window_and_no_cartesian_product(name, spark, sf):
    plan = plan_of(entry.queries()[name](spark, sf))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    windows = [line for line in plan.splitlines() if re.search(r"\bWindow\b", line)]
    assert not windows, windows


def test_filters_and_columns_reach_the_scan(spark, sf):
    plan = plan_of(entry.queries()["g3_append"](spark, sf))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,100000.0)]" in plan
    assert "o_orderdate" not in plan
    # the observation table reads only what is asked for
    assert "lineitem" not in plan_of(entry.queries()["i17_back_transform"](spark, sf))


def test_fitted_transforms_run_on_a_stream(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    params = fit_min_max(orders, ["o_totalprice"])
    apply = lambda df: flag_nonzero(log_transform(recode(encode_ordinals(apply_min_max(df, params), {
        "o_orderstatus": {"F": 0, "O": 1, "P": 2}}, check=False), {"o_orderpriority": {"5-LOW": "rest"}}), ["o_totalprice"]), "late", "o_orderstatus")
    stream = apply(spark.readStream.schema(orders.schema).parquet(f"{sf}/orders*.parquet"))
    run = stream.writeStream.format("memory").queryName("scored").outputMode("append").trigger(availableNow=True).start()
    run.awaitTermination(120)
    got, expected = spark.table("scored"), apply(orders)
    assert got.count() == expected.count() and got.exceptAll(expected).count() == 0
