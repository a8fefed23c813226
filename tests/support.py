"""Session and comparison shared by the tests and the checker."""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]").appName("tabkit")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _canon(df: pd.DataFrame) -> pd.DataFrame:
    out = pd.DataFrame(index=range(len(df)))
    for c in sorted(df.columns):
        s = df[c]
        if s.dtype == bool or str(s.dtype) in ("bool", "boolean"):
            s = s.astype(object).map(lambda v: None if v is None or v is pd.NA else float(v))
        if pd.api.types.is_numeric_dtype(s):
            s = s.astype(float)
        elif len(s) and s.dropna().map(lambda v: isinstance(v, (int, float, np.number))).all():
            s = s.astype(float)
        out[c] = s.to_numpy()
    return out.sort_values(list(out.columns), ignore_index=True, key=lambda s: s if s.dtype != object else s.map(str)) if len(out.columns) else out


def same_rows(got: pd.DataFrame, expected: pd.DataFrame) -> str | None:
    """None when two results hold the same rows in any order, else what differs."""
    if sorted(got.columns) != sorted(expected.columns):
        return f"columns {sorted(got.columns)} != {sorted(expected.columns)}"
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    a, b = _canon(got), _canon(expected)
    for c in a.columns:
        x, y = a[c], b[c]
        if x.dtype != object and y.dtype != object:
            both = np.isnan(x) & np.isnan(y)
            wrong = ~(both | (x == y))
        else:
            wrong = pd.Series([str(p) != str(r) if not (pd.isna(p) and pd.isna(r)) else False for p, r in zip(x, y)])
        if wrong.any():
            i = int(np.argmax(wrong.to_numpy()))
            return f"{c}: {int(wrong.sum())} differ, first {a.iloc[i].to_dict()} != {b.iloc[i].to_dict()}"
    return None
