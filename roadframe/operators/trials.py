"""Search over continuous ranges with a trial log that a restarted driver resumes from.

A trial's parameters depend on the seed and the trial's number alone, so a resumed
or longer search draws the same ones. The log is a Parquet table with a row for each
trial and fold, appended when the fit is scored; what it already holds is not fitted
again. Its rows carry the search's key (space, seed, data name), so several searches
share one log.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LOG = "search string, trial int, fold string, params string, score double"


@dataclass(frozen=True)
class Uniform:
    lo: float
    hi: float

    def draw(self, rng: random.Random) -> float:
        return rng.uniform(self.lo, self.hi)

    def holds(self, x: float) -> bool:
        return self.lo <= x <= self.hi


@dataclass(frozen=True)
class LogUniform:
    lo: float
    hi: float

    def draw(self, rng: random.Random) -> float:
        return min(self.hi, max(self.lo, math.exp(rng.uniform(math.log(self.lo), math.log(self.hi)))))

    def holds(self, x: float) -> bool:
        return self.lo <= x <= self.hi


@dataclass(frozen=True)
class Whole:
    """Whole numbers from ``lo`` to ``hi``, both included."""

    lo: int
    hi: int

    def draw(self, rng: random.Random) -> int:
        return rng.randint(self.lo, self.hi)

    def holds(self, x: float) -> bool:
        return x == int(x) and self.lo <= x <= self.hi


#: Ranges of the boosted trees' objective search, and of the inverse regularisation strength C of the regression.
RANGES: dict[str, dict] = {
    "gbt": {"stepSize": Uniform(0.01, 0.3), "maxDepth": Whole(3, 10), "subsamplingRate": Uniform(0.7, 1.0), "colsample": Uniform(0.7, 1.0), "maxIter": Whole(50, 300)},
    "logistic_regression": {"C": LogUniform(0.01, 10.0), "elasticNetParam": Uniform(0.0, 1.0)},
}


def draw(space: dict, trial: int, seed: int = 42) -> dict:
    """The parameters of one trial."""
    rng = random.Random(f"{seed}/{trial}")
    return {k: space[k].draw(rng) for k in sorted(space)}


def estimator_params(params: dict, rows: int) -> dict:
    """Spark's names and scales: a share of columns as text, C as the penalty 1 / (C * rows)."""
    out = dict(params)
    if "colsample" in out:
        out["featureSubsetStrategy"] = str(out.pop("colsample"))
    if "C" in out:
        out["regParam"] = 1.0 / (out.pop("C") * rows)
    return out


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The log's rows, each trial and fold once (a driver that died between writing and reading may have repeated one)."""
    try:
        log = spark.read.schema(LOG).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG)
    once = Window.partitionBy("search", "trial", "fold").orderBy("params", "score")
    return log.withColumn("n", F.row_number().over(once)).where("n = 1").drop("n")


def run_trials(spark: SparkSession, log: str, search: str, space: dict, folds: list, score: Callable[[dict, object], float], trials: int = 50, seed: int = 42, parallel: int = 4) -> int:
    """Fit and score every (trial, fold) that the log lacks, ``parallel`` at a time; returns how many were run.

    ``score(params, fold)`` trains on all other folds and gives the fold's score. Rows are appended a trial at a time,
    so a driver that dies loses one trial at most.
    """
    done = {(r.trial, r.fold) for r in read_log(spark, log).where(F.col("search") == search).select("trial", "fold").collect()}
    ran = 0
    with ThreadPool(parallel) as pool:
        for t in range(trials):
            params = draw(space, t, seed)
            open_ = [f for f in folds if (t, str(f)) not in done]
            if not open_:
                continue
            scores = pool.map(inheritable_thread_target(spark)(lambda f, p=params: float(score(p, f))), open_)
            rows = [(search, t, str(f), json.dumps(params, sort_keys=True), s) for f, s in zip(open_, scores, strict=True)]
            spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(log)
            ran += len(open_)
    return ran


def trial_means(log: DataFrame) -> DataFrame:
    """(search, trial, params, folds, mean_score, best): best is the first trial of largest mean."""
    means = log.groupBy("search", "trial", "params").agg(F.count(F.lit(1)).alias("folds"), F.avg("score").alias("mean_score"))
    best = F.row_number().over(Window.partitionBy("search").orderBy(F.desc("mean_score"), "trial")) == 1
    return means.withColumn("best", best)
