"""Record of training runs on shared storage: parameters, metrics and model of each, the best one looked up.

A run has a folder of its own, named by its id, which a repeated run
overwrites; so a driver that starts again leaves one row. The model is written
before the row: a run that is listed has its model.
"""

from __future__ import annotations

import json
import re

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadframe.sources.csv_scan import path_exists

RUN = "run string, params string, metrics map<string,double>, model string"


def record_run(spark: SparkSession, folder: str, run: str, params: dict, metrics: dict[str, float | None], model: PipelineModel | None = None) -> None:
    """Write one run. ``run`` names its folder: letters, digits, ``.``, ``_`` and ``-``, beginning with a letter or digit."""
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", run):
        raise ValueError(f"not a run id: {run!r}")
    path = None
    if model is not None:
        path = f"{folder.rstrip('/')}/models/{run}"
        model.write().overwrite().save(path)
    row = (run, json.dumps(params, sort_keys=True), {k: None if v is None else float(v) for k, v in metrics.items()}, path)
    spark.createDataFrame([row], RUN).coalesce(1).write.mode("overwrite").parquet(f"{folder.rstrip('/')}/runs/{run}")


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each recorded run; none for a folder without runs."""
    where = f"{folder.rstrip('/')}/runs"
    return spark.read.schema(RUN).option("recursiveFileLookup", True).parquet(where) if path_exists(spark, where) else spark.createDataFrame([], RUN)


def ranked_runs(recorded: DataFrame, metric: str) -> DataFrame:
    """The runs with ``best`` (boolean): the largest ``metric``, the smaller id if tied. Missing values and NaN are never best."""
    value = F.try_element_at("metrics", F.lit(metric))
    usable = F.when(~F.isnan(value), value)
    first = recorded.where(usable.isNotNull()).agg(F.min(F.struct((-usable).alias("v"), F.col("run"))).alias("__first"))
    return recorded.crossJoin(F.broadcast(first)).withColumn("best", F.coalesce(F.col("run") == F.col("__first.run"), F.lit(False))).drop("__first")


def best_model(spark: SparkSession, folder: str, metric: str) -> tuple[str, PipelineModel]:
    """Id and loaded model of the best run that has a model."""
    row = ranked_runs(runs(spark, folder).where("model IS NOT NULL"), metric).where("best").first()
    if row is None:
        raise ValueError(f"{folder}: no run with a model and {metric}")
    return row["run"], PipelineModel.load(row["model"])
