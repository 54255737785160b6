"""Training on the user table: fold-wise preparation, out-of-fold scores, early stopping, continuous search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadframe import rules as R
from roadframe.operators.schema import split_by_dtype
from roadframe.operators.training import TrainingPipeline, out_of_fold, statistics
from roadframe.plans.catalog import ORACLES, register
from roadframe.plans.queries_etl import user_feature_table
from roadframe.session import scratch_path

LABEL, FOLDS, VARIANCE = "grav", 5, 0.01
#: All users of an accident share its time, so they share a fold and none of them is scored by a model that saw the others.
FOLD = f"CAST((CAST(mois AS BIGINT) * 744 + CAST(jour AS BIGINT) * 24 + CAST(hr AS BIGINT)) % {FOLDS} AS INT)"


def training_table(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str], list[str]]:
    """The user table without the columns that training drops, with its folds, written once; numeric and other features."""
    path = scratch_path(spark, "training-table")
    user_feature_table(spark, sf_dir).withColumn("fold", F.expr(FOLD)).drop(*R.TRAINING_DROPPED).write.parquet(path)
    df = spark.read.parquet(path)
    features = df.drop(LABEL, "fold")
    return df, *split_by_dtype(features)


def _encodings_sql() -> str:
    table = ORACLES["user_feature_table"]
    numeric = [*_NUMERIC]
    text = [*_TEXT]
    numbers = " UNION ALL ".join(f"SELECT fold, '{c}' AS name, CASE WHEN CAST(\"{c}\" AS DOUBLE) <> -1 THEN CAST(\"{c}\" AS DOUBLE) END AS x FROM t" for c in numeric)
    values = " UNION ALL ".join(f"SELECT fold, '{c}' AS name, CASE WHEN \"{c}\" <> '-1' THEN \"{c}\" END AS v FROM t" for c in text)
    return f"""
WITH t AS MATERIALIZED (SELECT *, {FOLD} AS fold FROM ({table}) AS u),
k AS (SELECT DISTINCT fold AS k FROM t),
n AS (SELECT k, name, count(*) AS rows, avg(x) AS mean, min(x) AS lo, max(x) AS hi, coalesce(var_pop(x) * count(x) / count(*), 0) AS v FROM ({numbers}) JOIN k ON fold <> k GROUP BY k, name),
c AS (SELECT k, name, v, count(*) AS n FROM ({values}) JOIN k ON fold <> k GROUP BY k, name, v),
m AS (SELECT k, name, v FROM (SELECT *, row_number() OVER (PARTITION BY k, name ORDER BY n DESC, v) AS i FROM c WHERE v IS NOT NULL) WHERE i = 1),
s AS (SELECT c.k, c.name, c.v, (c.n + CASE WHEN c.v = m.v THEN coalesce(u.n, 0) ELSE 0 END) / (SELECT sum(a.n) FROM c a WHERE a.k = c.k AND a.name = c.name) AS p,
             row_number() OVER (PARTITION BY c.k, c.name ORDER BY c.v) AS i
      FROM c JOIN m ON m.k = c.k AND m.name = c.name LEFT JOIN c u ON u.k = c.k AND u.name = c.name AND u.v IS NULL WHERE c.v IS NOT NULL),
e AS (SELECT k, name, CASE WHEN hi > lo THEN v / (hi - lo) / (hi - lo) ELSE 0 END AS variance FROM n
      UNION ALL SELECT k, name || '_' || v, p * (1 - p) FROM s WHERE i > 1),
g AS (SELECT k, CAST({LABEL} AS VARCHAR) AS name, count(*) AS n FROM t JOIN k ON fold <> k GROUP BY k, {LABEL})
SELECT fold, statistic, name, text, round(value, 9) AS value FROM (
SELECT k AS fold, 'mean' AS statistic, name, CAST(NULL AS VARCHAR) AS text, mean AS value FROM n
UNION ALL SELECT k, 'min', name, NULL, lo FROM n
UNION ALL SELECT k, 'max', name, NULL, hi FROM n
UNION ALL SELECT k, 'mode', name, v, NULL FROM m
UNION ALL SELECT k, 'variance', name, CASE WHEN variance > {VARIANCE} THEN 'kept' ELSE 'removed' END, variance FROM e
UNION ALL SELECT k, 'class', name, NULL, CAST(n AS DOUBLE) FROM g
UNION ALL SELECT k, 'balanced', name, NULL, CAST(min(n) OVER (PARTITION BY k) AS DOUBLE) FROM g)
"""


#: The user table's features by type, as training sees them (the SQL check needs them before any table is read).
_TEXT = [c for c in R.REQUIRED_COLUMNS if R.FEATURE_DICTIONARY[c]["type"] == "categorial" and not c.startswith(("imply_", "has_", "choc_")) and c not in ("agg", "hr", "jour", "mois")]
_NUMERIC = [c for c in R.REQUIRED_COLUMNS if c not in _TEXT]


@register("fold_encodings", _encodings_sql())
def fold_encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1-M3d, M6, M7: what the preparation learns on each fold's training part, and the class sizes before and after under-sampling."""
    df, numeric, text = training_table(spark, sf_dir)
    pipeline = TrainingPipeline(LABEL, numeric, text, threshold=VARIANCE)
    parts, rows = statistics(df, numeric, text, F.col("fold")), []
    for f in sorted(parts):
        e = pipeline.encode(sum((p for g, p in sorted(parts.items()) if g != f), type(parts[f])()))
        rows += [(f, "mean", c, None, v) for c, v in e.means.items()]
        rows += [(f, s, c, None, r[i] if r else None) for c, r in e.ranges.items() for i, s in enumerate(("min", "max"))]
        rows += [(f, "mode", c, v, None) for c, v in e.modes.items() if v is not None]
        rows += [(f, "variance", c, "kept" if c in set(e.kept) else "removed", v) for c, v in e.variances.items()]
        train = df.where(F.col("fold") != f)
        for s, part in (("class", train), ("balanced", pipeline.training_rows(train))):
            rows += [(f, s, str(r[LABEL]), None, float(r["count"])) for r in part.groupBy(LABEL).count().collect()]
    return spark.createDataFrame(rows, "fold int, statistic string, name string, text string, value double").withColumn("value", F.round("value", 9))


def scored_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user with the probability given by the forest that was trained without its fold."""
    df, numeric, text = training_table(spark, sf_dir)
    pipeline = TrainingPipeline(LABEL, numeric, text, "random_forest", {"numTrees": 50, "maxDepth": 6, "minInstancesPerNode": 2}, threshold=VARIANCE)
    return out_of_fold(df.withColumn("row", F.xxhash64(*df.columns)), "fold", pipeline, threshold=0.6)


@register("out_of_fold_metrics")
def out_of_fold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of each fold by the model that has not seen it, and their mean and deviation over folds."""
    from roadframe.operators.evaluate import fold_summary, per_fold_metrics
    names = ["accuracy", "precision", "recall", "f1"]
    folds = per_fold_metrics(scored_folds(spark, sf_dir), LABEL, "prediction", "fold")
    rows = folds.select(F.col("fold").cast("string").alias("fold"), *names)
    summary = fold_summary(folds, names)
    for s in ("mean", "std"):
        rows = rows.unionByName(summary.select(F.lit(s).alias("fold"), *[F.col(f"{c}_{s}").alias(c) for c in names]))
    return rows


@register("out_of_fold_coverage", f"""
SELECT {FOLD} AS fold, {LABEL} AS label, count(*) AS n, count(*) AS n_scored, 0 AS n_wrong_cells FROM ({ORACLES['user_feature_table']}) AS u GROUP BY 1, 2
""")
def out_of_fold_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user is scored once; the summed matrix of the folds agrees with the fold metrics cell by cell."""
    from roadframe.operators.evaluate import per_fold_metrics
    scored = scored_folds(spark, sf_dir)
    own = scored.groupBy("fold", F.col(LABEL).alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("p1").between(0, 1) & ((F.col("p1") >= 0.6).cast("int") == F.col("prediction")), 1)).alias("n_scored"),
        F.count_if(F.col("prediction") == 1).alias("said_1"), F.count_if(F.col("prediction") == 0).alias("said_0"))
    cells = per_fold_metrics(scored, LABEL, "prediction", "fold").select(F.col("fold").alias("of"), "tp", "fp", "fn", "tn")
    one, zero = F.col("label") == 1, F.col("label") == 0
    wrong = F.when(one, (F.col("tp") != F.col("said_1")).cast("int") + (F.col("fn") != F.col("said_0")).cast("int")).when(
        zero, (F.col("fp") != F.col("said_1")).cast("int") + (F.col("tn") != F.col("said_0")).cast("int"))
    return own.join(cells, F.col("fold") == F.col("of")).select("fold", "label", "n", "n_scored", wrong.alias("n_wrong_cells"))


def _boosted(spark: SparkSession, sf_dir: str):
    """(parts of the balanced users as a written table, the boosted model with its losses)."""
    from pyspark.ml import PipelineModel

    from roadframe.operators.boosting import exact_split, fit_early_stopped
    df, numeric, text = training_table(spark, sf_dir)
    pipeline = TrainingPipeline(LABEL, numeric, text, threshold=VARIANCE, pca_share=None)
    (part,) = statistics(df, numeric, text).values()
    stages = PipelineModel(stages=pipeline.encode(part).stages("features"))
    rows = exact_split(pipeline.training_rows(df.drop("fold")))
    path = scratch_path(spark, "boosting-parts")
    stages.transform(rows).select("part", F.col(LABEL).cast("double").alias("label"), "features").write.parquet(path)
    parts = spark.read.parquet(path)
    train, validation = (parts.where(F.col("part") == p) for p in ("train", "validation"))
    return parts, fit_early_stopped(train, validation, rounds=300, patience=15, maxDepth=6, stepSize=0.1)


@register("boosting_rounds")
def boosting_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3, L4: training and validation loss of every boosting round looked at, and the round that is kept."""
    return _boosted(spark, sf_dir)[1].table(spark)


@register("boosting_split_and_stop", f"""
WITH g AS (SELECT 2 * min(n) AS n FROM (SELECT count(*) AS n FROM ({ORACLES['user_feature_table']}) AS u GROUP BY {LABEL})),
s AS (SELECT n, CAST(ceil(0.2 * n) AS BIGINT) AS test FROM g),
v AS (SELECT *, CAST(ceil(0.125 * (n - test)) AS BIGINT) AS validation FROM s)
SELECT 'test' AS name, test AS n FROM v UNION ALL SELECT 'validation', validation FROM v UNION ALL SELECT 'train', n - test - validation FROM v
UNION ALL SELECT 'rounds chosen', 1 UNION ALL SELECT 'rounds before the chosen one with no larger loss', 0 UNION ALL SELECT 'rounds after the chosen one with smaller loss', 0
UNION ALL SELECT 'gaps in the rounds', 0 UNION ALL SELECT 'trees that are not of the chosen round', 0
""")
def boosting_split_and_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5, L4: sizes of the 70/10/20 parts, and the stopping rule recomputed from the written losses."""
    parts, boosted = _boosted(spark, sf_dir)
    losses = boosted.table(spark)
    best = losses.where("chosen").select(F.col("round").alias("best"), F.col("validation_loss").alias("least"))
    checks = losses.join(F.broadcast(best)).agg(
        F.count_if("chosen").alias("rounds chosen"),
        F.count_if((F.col("round") < F.col("best")) & (F.col("validation_loss") <= F.col("least"))).alias("rounds before the chosen one with no larger loss"),
        F.count_if((F.col("round") > F.col("best")) & (F.col("validation_loss") < F.col("least"))).alias("rounds after the chosen one with smaller loss"),
        (F.max("round") - F.count(F.lit(1))).alias("gaps in the rounds"),
        F.abs(F.max("best") - F.lit(boosted.model.getNumTrees)).alias("trees that are not of the chosen round"))
    cells = F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("long").alias("n")) for c in checks.columns]))
    return parts.groupBy(F.col("part").alias("name")).agg(F.count(F.lit(1)).alias("n")).unionByName(checks.select(cells))


#: Trials of the registered search, on folds of all labelled documents.
TRIALS = 50


def gathered(rows: DataFrame, n: int) -> DataFrame:
    """``rows``, of which there are ``n``, in few partitions.

    They are shuffled into them: merged without one, a task would run all sorts and joins of the partitions it merges, one after the other.
    """
    return rows.repartition(1 + n // 100_000)


def _searched(spark: SparkSession, sf_dir: str, log: str, trials: int) -> int:
    from roadframe.operators import trials as T
    from roadframe.operators.models import make_estimator
    from roadframe.plans.queries_ml import document_rows
    path = scratch_path(spark, "trial-documents")
    labelled = document_rows(spark, sf_dir).where("label IS NOT NULL").withColumn("fold", F.pmod("doc_id", F.lit(FOLDS)).cast("int"))
    labelled.drop("doc_id").write.parquet(path)
    df = spark.read.parquet(path)
    pipeline = TrainingPipeline("label", ["n_chars", "log_chars", "toxic"], ["lang", "source"], "decision_tree", {"maxDepth": 1}, pca_share=None, threshold=0.0, balance=False)
    parts = statistics(df, pipeline.numeric, pipeline.categorical, F.col("fold"))
    ready = {}
    for f in sorted(parts):  # the preparation of a fold is the same for all trials
        from pyspark.ml import PipelineModel
        others = sum((p for g, p in sorted(parts.items()) if g != f), type(parts[f])())
        rows = PipelineModel(stages=pipeline.encode(others).stages("features")).transform(df).select("fold", "label", "features")
        balanced = gathered(pipeline.__class__("label", [], [], balance=True).training_rows(rows.where(F.col("fold") != f)), others.rows).persist()
        ready[f] = (balanced, balanced.count(), rows.where(F.col("fold") == f).persist())

    def score(params: dict, fold) -> float:
        train, n, test = ready[fold]
        model = make_estimator("logistic_regression", "features", "label", **T.estimator_params(params, n)).fit(train)
        return model.transform(test).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]

    try:
        return T.run_trials(spark, log, "logistic_regression", T.RANGES["logistic_regression"], sorted(ready), score, trials=trials)
    finally:
        for train, _, test in ready.values():
            train.unpersist()
            test.unpersist()


@register("continuous_trials", f"""
SELECT 'trials' AS name, {TRIALS} AS n UNION ALL SELECT 'fits', {TRIALS * FOLDS} UNION ALL SELECT 'fits before the restart', {TRIALS // 2 * FOLDS}
UNION ALL SELECT 'fits after the restart', {(TRIALS - TRIALS // 2) * FOLDS} UNION ALL SELECT 'repeated trials and folds', 0
UNION ALL SELECT 'parameters out of range', 0 UNION ALL SELECT 'best trials', 1 UNION ALL SELECT 'trials above the best', 0
""")
def continuous_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trials over continuous ranges on all folds; the driver stops after half of them and resumes from the log."""
    from roadframe.operators import trials as T
    log = scratch_path(spark, "trials")
    first = _searched(spark, sf_dir, log, TRIALS // 2)
    second = _searched(spark, sf_dir, log, TRIALS)
    rows, means = spark.read.schema(T.LOG).parquet(log), T.trial_means(T.read_log(spark, log))
    space = T.RANGES["logistic_regression"]
    inside = F.lit(True)
    for c in sorted(space):
        x = F.get_json_object("params", f"$.{c}").cast("double")
        inside = inside & F.coalesce(x.between(space[c].lo, space[c].hi), F.lit(False))
    counts = rows.agg(F.countDistinct("trial").alias("trials"), F.count(F.lit(1)).alias("fits"), (F.count(F.lit(1)) - F.countDistinct("trial", "fold")).alias("repeated trials and folds"),
                      F.count_if(~inside).alias("parameters out of range"), F.lit(first).alias("fits before the restart"), F.lit(second).alias("fits after the restart"))
    best = means.agg(F.count_if("best").alias("best trials"), (F.count_if(F.col("mean_score") > F.lit(means.where("best").first()["mean_score"]))).alias("trials above the best"))
    out = None
    for df in (counts, best):
        cells = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("long").alias("n")) for c in df.columns])))
        out = cells if out is None else out.unionByName(cells)
    return out
