"""Keeping fitted models, weights and trial logs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.operators.ensemble import FittedStack, FittedVoter
from tabkit.operators.regress import FittedKernel, FittedML, KernelRobust, LinearFit
from tabkit.operators.robust import FittedRobust, RobustKernel

KEPT = "top boolean, kind string, name string, features array<string>, intercept double, coef array<double>"
LOG_KEY = ("dataset", "model", "trial_id")
LOG_SCHEMA = "dataset string, model string, trial_id bigint, params map<string,double>, cv_rmse double"


def save_models(spark: SparkSession, models: Mapping[str, object], folder: str) -> None:
    """Models of every kind as table rows, Spark ML parts in their own format under ``ml/<name>``.

    A stack or a voter is a row that names its members, which are rows of their own below its name.
    """
    rows = []

    def keep(name: str, m: object, top: bool) -> None:
        if isinstance(m, LinearFit):
            rows.append((top, "linear", name, list(m.features), float(m.intercept), [float(w) for w in m.coef]))
        elif isinstance(m, FittedML):
            m.model.write().overwrite().save(f"{folder}/ml/{name}")
            rows.append((top, "ml", name, list(m.features), None, None))
        elif isinstance(m, FittedKernel):
            m.model.write().overwrite().save(f"{folder}/ml/{name}")
            spec = m.spec
            rows.append((top, "kernel", name, list(m.features), None, [float(x) for x in (spec.gamma, spec.c, spec.epsilon, spec.width, spec.seed)]))
        elif isinstance(m, FittedRobust):
            spec = m.spec
            rows.append((top, "robust", name, list(m.features), float(m.intercept), [float(x) for x in (spec.gamma, spec.c, spec.epsilon, spec.width, spec.seed, *m.coef)]))
        elif isinstance(m, FittedStack):
            rows.append((top, "stack", name, list(m.members), None, None))
            keep(f"{name}/meta", m.meta, False)
            for n, x in m.members.items():
                keep(f"{name}/member/{n}", x, False)
        elif isinstance(m, FittedVoter):
            rows.append((top, "voter", name, list(m.members), None, [float(m.weights[n]) for n in m.members]))
            for n, x in m.members.items():
                keep(f"{name}/member/{n}", x, False)
        else:
            raise TypeError(f"cannot store {type(m).__name__}")

    for name, m in models.items():
        keep(name, m, True)
    spark.createDataFrame(rows, KEPT).coalesce(1).write.mode("overwrite").parquet(f"{folder}/models.parquet")


def load_models(spark: SparkSession, folder: str) -> dict[str, object]:
    """Models by name; they predict as before."""
    rows = {r["name"]: r for r in spark.read.parquet(f"{folder}/models.parquet").collect()}

    def model(name: str) -> object:
        r = rows[name]
        if r["kind"] == "linear":
            return LinearFit(tuple(r["features"]), r["intercept"], tuple(r["coef"]))
        if r["kind"] == "robust":
            gamma, c, epsilon, width, seed, *coef = r["coef"]
            return FittedRobust(RobustKernel(gamma, c, epsilon, int(width), int(seed)), tuple(r["features"]), r["intercept"], tuple(coef))
        if r["kind"] in ("ml", "kernel"):
            part = DefaultParamsReader.loadParamsInstance(f"{folder}/ml/{name}", spark.sparkContext)
            if r["kind"] == "ml":
                return FittedML(tuple(r["features"]), part)
            gamma, c, epsilon, width, seed = r["coef"]
            return FittedKernel(KernelRobust(gamma, c, epsilon, int(width), int(seed)), tuple(r["features"]), part)
        members = {n: model(f"{name}/member/{n}") for n in r["features"]}
        if r["kind"] == "stack":
            return FittedStack(members, model(f"{name}/meta"))
        return FittedVoter(members, dict(zip(r["features"], r["coef"])))

    return {name: model(name) for name, r in rows.items() if r["top"]}


def append_trials(scored: DataFrame, path: str, dataset: str, model: str) -> None:
    """Add scored trials to the log of a search; a trial that is in the log already is replaced.

    The log is partitioned by ``(dataset, model, trial_id)`` and only the partitions written are overwritten, at the commit of the
    write: a repeated append changes nothing, and one that is interrupted leaves the log as it was.
    """
    rows = scored.select(F.lit(dataset).alias("dataset"), F.lit(model).alias("model"), F.col("trial_id").cast("bigint"), "params", "cv_rmse")
    rows.repartition("trial_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*LOG_KEY).parquet(path)


def read_trials(spark: SparkSession, path: str, dataset: str, model: str) -> DataFrame:
    """Logged trials of one search; only its folders are read. A log that was never written has none."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], LOG_SCHEMA)
    log = spark.read.schema(LOG_SCHEMA).parquet(path)
    return log.filter((F.col("dataset") == dataset) & (F.col("model") == model)).select("dataset", "model", "trial_id", "params", "cv_rmse")
