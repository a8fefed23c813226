"""The housing table: its fixed values, and its preparation as one flow of operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tabkit.functions.expr import q
from tabkit.operators.encode import (
    encode_ordinals, inverse_scale, level_lists, min_max_scale, one_hot, ordinal_map_from_data, round_numeric,
)
from tabkit.operators.features import (
    add_ratio, flag_any_nonzero, flag_nonzero, log_transform, recode, row_mean, sum_columns, weighted_sum,
)
from tabkit.operators.impute import impute_categoricals, impute_chained, impute_few
from tabkit.operators.roles import Roles, columns_matching, enforce_types
from tabkit.operators.rows import apply_corrections, drop_first_match, drop_matching, drop_sparse_columns
from tabkit.plans.variants import build_variants
from tabkit.session import store

# --- fixed values: roles of the columns ----------------------------------------------------------

CAT = (
    "MSSubClass", "MSZoning", "Street", "LandContour", "LotConfig", "Neighborhood", "Condition1", "Condition2",
    "BldgType", "HouseStyle", "RoofStyle", "RoofMatl", "Exterior1st", "Exterior2nd", "MasVnrType", "Foundation",
    "Heating", "CentralAir", "Electrical", "GarageType", "MiscFeature", "SaleType", "SaleCondition", "Alley",
)
ORD = (
    "LotShape", "Utilities", "LandSlope", "OverallQual", "OverallCond", "ExterQual", "ExterCond", "BsmtQual",
    "BsmtCond", "BsmtExposure", "BsmtFinType1", "BsmtFinType2", "HeatingQC", "BsmtFullBath", "BsmtHalfBath",
    "FullBath", "HalfBath", "BedroomAbvGr", "KitchenAbvGr", "KitchenQual", "TotRmsAbvGrd", "Functional",
    "Fireplaces", "FireplaceQu", "GarageFinish", "GarageCars", "GarageQual", "GarageCond", "PavedDrive", "PoolQC",
    "Fence", "MoSold", "YrSold",
)
QUANT = (
    "LotFrontage", "LotArea", "YearBuilt", "YearRemodAdd", "MasVnrArea", "BsmtFinSF1", "BsmtFinSF2", "BsmtUnfSF",
    "TotalBsmtSF", "1stFlrSF", "2ndFlrSF", "LowQualFinSF", "GrLivArea", "GarageYrBlt", "GarageArea", "WoodDeckSF",
    "OpenPorchSF", "EnclosedPorch", "3SsnPorch", "ScreenPorch", "PoolArea", "MiscVal", "SalePrice",
)
RESPONSE = "SalePrice"
KEY = ("split", "id")
ROLES = Roles(cat=CAT, ord=ORD, quant=QUANT, response=RESPONSE, key=KEY)

# --- fixed values: codes of the ordinal levels; None is a missing value --------------------------

CONDITION = {None: 0, "Po": 1, "Fa": 2, "TA": 3, "Gd": 4, "Ex": 5}
CONDITION_NO_EX = {None: 0, "Po": 1, "Fa": 2, "TA": 3, "Gd": 4}
QUALITY = {None: 0, "Fa": 1, "TA": 2, "Gd": 3, "Ex": 4}
FINISH = {None: 0, "Unf": 1, "LwQ": 2, "Rec": 3, "BLQ": 4, "ALQ": 5, "GLQ": 6}

ORDINAL_CODES: dict[str, dict] = {
    "GarageCond": CONDITION,
    "BsmtCond": CONDITION_NO_EX,
    "LandSlope": {"Gtl": 0, "Mod": 1, "Sev": 2},
    "PavedDrive": {"N": 0, "P": 1, "Y": 2},
    "GarageFinish": {None: 0, "Unf": 1, "RFn": 2, "Fin": 3},
    "BsmtQual": QUALITY,
    "GarageQual": CONDITION,
    "LotShape": {"Reg": 0, "IR1": 1, "IR2": 2, "IR3": 3},
    "ExterCond": CONDITION,
    "ExterQual": {"Fa": 0, "TA": 1, "Gd": 2, "Ex": 3},
    "HeatingQC": CONDITION,
    "KitchenQual": QUALITY,
    "BsmtFinType1": FINISH,
    "BsmtFinType2": FINISH,
    "BsmtExposure": {None: 0, "No": 1, "Mn": 2, "Av": 3, "Gd": 4},
    "Fence": {None: 0, "MnPrv": 1, "MnWw": 2, "GdWo": 3, "GdPrv": 4},
    "FireplaceQu": CONDITION,
    "PoolQC": QUALITY,
    "Utilities": {None: None, "ELO": 0, "NoSeWa": 1, "NoSewr": 2, "AllPub": 3},
}
# codes taken from the order of first appearance
CODED_FROM_DATA = ("Functional",)

# --- fixed values: merged levels -----------------------------------------------------------------

MERGED_LEVELS: dict[str, dict] = {
    "MSSubClass": {"150": "50"},
    "Condition2": {"PosA": "Other", "PosN": "Other", "RRNn": "Other", "RRAn": "Other", "RRAe": "Other"},
    "RoofMatl": {"WdShake": "Wood", "WdShingle": "Wood", "Roll": "Other", "Metal": "Other", "Membran": "Other"},
    "Exterior1st": {"BrkComm": "BrkFace", "AsphShn": "AsbShng", "ImStucc": "Stucco", "Stone": "Other", "CBlock": "Other"},
    "Exterior2nd": {"AsphShn": "AsbShng", "Stone": "Other", "CBlock": "Other"},
    "Heating": {"Wall": "Other", "OthW": "Other", "Floor": "Other"},
    "MasVnrType": {"BrkComm": "BrkFace"},
    "Electrical": {"FuseA": "NonStd", "FuseF": "NonStd", "FuseP": "NonStd", "Mix": "NonStd"},
}

# --- fixed values: columns of the reduced variant, unlogged columns, limits ----------------------

REDUCED_WITHOUT = (
    "Heating", "RoofMatl", "Condition2", "Street", "Exterior2nd", "HouseStyle", "Utilities", "PoolQC", "1stFlrSF",
    "TotalBsmtSF", "GarageYrBlt", "PoolArea", "MiscVal", "3SsnPorch", "ScreenPorch", "BsmtFinSF2", "LowQualFinSF",
)
NOT_LOGGED = ("YearBuilt", "YearRemodAdd", "GarageYrBlt", "GarageArea", "AvgCond")
SPARSE_LIMIT = 0.20
FEW = {"max_cat": 4, "max_ord": 2, "max_quant": 1}
CORRECTION = ("test", 2593, "GarageYrBlt", "2007")


def outlier_rules():
    """The two outlier conditions."""
    return [
        (q("OverallQual") < 5) & (q("SalePrice") > 200000),
        (q("GrLivArea") > 4000) & (q("SalePrice") < 300000),
    ]


def encode(full: DataFrame, order=None) -> DataFrame:
    """Ordinal codes from the fixed maps and, for ``Functional``, from the order of appearance."""
    mapper: dict[str, Mapping] = dict(ORDINAL_CODES)
    ranked = full.withColumn("_train_last", q("split") != "train")
    for c in CODED_FROM_DATA:
        if c in full.columns:
            # one row per level
            seen = ordinal_map_from_data(ranked, c, ["_train_last", "id"]).collect()
            mapper[c] = {None: None, **{r["value"]: r["code"] for r in seen}}
    return encode_ordinals(full, mapper)


def prepare(full: DataFrame, outliers: str = "all", iterations: int = 6, donors: int = 20, classifier=None) -> DataFrame:
    """Raw stacked table to the clean one: encoded, pruned, imputed, typed.

    ``outliers='all'`` drops every row an outlier rule matches, ``'first'`` only the first of each.
    """
    df = encode(full)
    df = drop_sparse_columns(df, SPARSE_LIMIT, keep=[RESPONSE])
    df = drop_matching(df, outlier_rules()) if outliers == "all" else drop_first_match(df, outlier_rules())
    if CORRECTION[2] in df.columns:
        fixes = df.sparkSession.createDataFrame([CORRECTION], "split string, id bigint, `column` string, value string")
        df = apply_corrections(df, fixes, KEY, [CORRECTION[2]])
    df = store(df)
    roles = ROLES.within(df)
    df = store(impute_few(df, roles, **FEW))
    df = impute_categoricals(df, roles, RESPONSE, classifier)
    df = store(impute_numbers(df, roles, iterations, donors))
    return enforce_types(df, roles)


def impute_numbers(df: DataFrame, roles: Roles, iterations: int, donors: int) -> DataFrame:
    """Chained regressions over scaled columns with the categorical ones as flags, then rounding."""
    nums = [c for c in (*roles.ord, *roles.quant) if c != RESPONSE]
    cats = list(roles.cat)
    wide = df.select("id", *[q(c) for c in cats], *[q(c).cast("double").alias(c) for c in nums])
    flagged = one_hot(wide, cats, level_lists(df, cats))
    scaled, params = min_max_scale(flagged, nums)
    flags = [c for c in scaled.columns if c not in nums and c != "id"]
    filled = impute_chained(scaled, "id", nums, flags, iterations, donors)
    back = round_numeric(inverse_scale(filled, params), nums).select("id", *[q(c) for c in nums])
    rest = df.select("split", "id", *[q(c) for c in cats], *([q(RESPONSE)] if RESPONSE in df.columns else []))
    return rest.join(back, "id").select(*[q(c) for c in df.columns])


def edit(df: DataFrame, present: frozenset[str]) -> DataFrame:
    """Merged levels and derived columns; averages take the columns the variant has."""
    df = recode(df, MERGED_LEVELS)
    df = flag_nonzero(df, "HasBsmt", "BsmtQual")
    for out, col in (("HasFireplace", "FireplaceQu"), ("HasPool", "PoolQC"), ("HasGarage", "GarageQual"), ("HasFence", "Fence"),
                     ("Has2ndFlr", "2ndFlrSF"), ("HasWoodDeck", "WoodDeckSF")):
        if col in df.columns:
            df = flag_nonzero(df, out, col)
    df = flag_any_nonzero(df, "HasPorch", [c for c in ("OpenPorchSF", "EnclosedPorch", "3SsnPorch", "ScreenPorch") if c in df.columns])
    quality = columns_matching(df, ["Qual", "Qu", "QC"], ["LowQualFinSF", "AvgQual"], [c for c in ORD if c in present])
    condition = columns_matching(df, ["Cond"], ["Sale", *quality], [c for c in ORD if c in present])
    df = row_mean(df, "AvgQual", quality)
    df = row_mean(df, "AvgCond", condition)
    df = weighted_sum(df, "Bath", {"HalfBath": 1, "FullBath": 2})
    df = weighted_sum(df, "BsmtBath", {"BsmtHalfBath": 1, "BsmtFullBath": 2})
    df = sum_columns(df, "OverallArea", ["LotArea", "GrLivArea", "GarageArea"])
    df = add_ratio(df, "LotRatio", "LotArea", "LotFrontage")
    logged = [c for c in (*QUANT, "AvgQual", "OverallArea", "LotRatio") if c not in NOT_LOGGED]
    return log_transform(df, logged, zero="min")


def variants(clean: DataFrame) -> dict[str, DataFrame]:
    """The four model datasets; the unbalanced ``Utilities`` leaves all of them."""
    made = build_variants(clean, REDUCED_WITHOUT, edit, RESPONSE)
    return {name: df.drop("Utilities") for name, df in made.items()}


# --- fixed values: search ranges (logs of powers of ten) -----------------------------------------

LN10 = 2.302585092994046
SPACES = {
    "ridge": {"alpha": ("loguniform", -3 * LN10, 2 * LN10)},
    "bridge": {n: ("loguniform", -9 * LN10, 3 * LN10) for n in ("alpha_1", "alpha_2", "lambda_1", "lambda_2")},
    # the robust loss needs an epsilon above 1
    "svr": {**{n: ("loguniform", -3 * LN10, 2 * LN10) for n in ("gamma", "C")}, "epsilon": ("uniform", 1.01, 3.0)},
    "xgb": {
        "max_depth": ("quniform", 1, 3, 1), "n_estimators": ("quniform", 100, 500, 50),
        "learning_rate": ("loguniform", -4 * LN10, 0.0), "gamma": ("loguniform", -3 * LN10, 2 * LN10),
        "min_child_weight": ("quniform", 1, 7, 1), "subsample": ("uniform", 0.25, 1.0), "colsample": ("uniform", 0.25, 1.0),
    },
    "voter": {f"voter{i}": ("uniform", 0.0, 1.0) for i in (1, 2, 3)},
}
INTEGER_PARAMETERS = ("max_depth", "min_child_weight", "n_estimators", "n_components")
