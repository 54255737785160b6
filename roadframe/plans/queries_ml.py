"""Sampling, preparation, model, evaluation and explanation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadframe.plans.catalog import register
from roadframe.session import read_table, scratch_path

_LABELED = """SELECT *, l_returnflag AS label FROM lineitem"""

# --------------------------------------------------------------------------
# sampling: exact sizes are the contract (membership uses a seeded hash)
# --------------------------------------------------------------------------
_CLASS_COUNTS = "c AS (SELECT l_returnflag AS label, count(*) AS n_c FROM lineitem GROUP BY 1)"


def _labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").withColumn("label", F.col("l_returnflag"))


@register("stratified_split_sizes", f"""
WITH {_CLASS_COUNTS},
t AS (SELECT sum(n_c) AS n, CAST(ceil(0.2 * sum(n_c)) AS BIGINT) AS n_test FROM c),
a AS (SELECT label, n_c, n_test * n_c / n AS ex, floor(n_test * n_c / n) AS fl FROM c, t),
r AS (SELECT label, n_c, fl, row_number() OVER (ORDER BY ex - fl DESC, label) AS rk FROM a),
alloc AS (SELECT label, n_c, CAST(fl + CASE WHEN rk <= (SELECT n_test FROM t) - (SELECT sum(fl) FROM a)
                                          THEN 1 ELSE 0 END AS BIGINT) AS k FROM r)
SELECT label, 'test' AS split, k AS n FROM alloc
UNION ALL SELECT label, 'train', n_c - k FROM alloc
""")
def stratified_split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: exact 80/20 stratified split (class ratios kept), sizes per (class, part)."""
    from roadframe.operators.sample import stratified_split
    s = stratified_split(_labeled(spark, sf_dir), "label", 0.2, seed=42)
    return s.groupBy("label", "split").agg(F.count(F.lit(1)).alias("n"))


@register("undersample_sizes", f"""
WITH {_CLASS_COUNTS} SELECT label, (SELECT min(n_c) FROM c) AS n FROM c
""")
def undersample_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: every class cut to the minority size, without replacement."""
    from roadframe.operators.sample import undersample
    return undersample(_labeled(spark, sf_dir), "label").groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@register("stratified_fold_sizes", f"""
WITH {_CLASS_COUNTS}, f AS (SELECT range AS fold FROM range(5))
SELECT label, CAST(fold AS INTEGER) AS fold,
       CAST(floor((fold + 1) * n_c / 5) - floor(fold * n_c / 5) AS BIGINT) AS n
FROM c, f
""")
def stratified_fold_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: 5 stratified folds; within a class fold j holds ranks [j*n/5, (j+1)*n/5)."""
    from roadframe.operators.sample import stratified_folds
    f = stratified_folds(_labeled(spark, sf_dir), "label", k=5)
    return f.groupBy("label", F.col("fold").cast("int").alias("fold")).agg(F.count(F.lit(1)).alias("n"))


@register("exact_sample_size", """
SELECT CAST(count(*) // 4 AS BIGINT) AS n_rows, CAST(count(*) // 4 AS BIGINT) AS n_distinct_rows FROM lineitem
""")
def exact_sample_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: exact-size random sample (a quarter of the rows), no duplicates."""
    from roadframe.operators.sample import sample_fraction_exact
    s = sample_fraction_exact(read_table(spark, sf_dir, "lineitem"), 0.25)
    return s.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_distinct(F.struct(*[F.col(c) for c in s.columns])).alias("n_distinct_rows"))


# --------------------------------------------------------------------------
# preparation
# --------------------------------------------------------------------------
_PREP_SRC = """SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE l_quantity END AS q,
  CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_discount END AS d,
  1.0 AS k FROM lineitem"""


@register("mean_impute_minmax", f"""
WITH s AS ({_PREP_SRC}),
m AS (SELECT avg(q) AS mq, avg(d) AS md, avg(k) AS mk FROM s),
f AS (SELECT l_orderkey, l_linenumber, l_partkey, COALESCE(q, mq) AS q, COALESCE(d, md) AS d, COALESCE(k, mk) AS k
      FROM s, m),
r AS (SELECT min(q) AS q0, max(q) AS q1, min(d) AS d0, max(d) AS d1 FROM f)
SELECT l_orderkey, l_linenumber, l_partkey, (q - q0) / (q1 - q0) AS q, (d - d0) / (d1 - d0) AS d, 0.0 AS k FROM f, r
""")
def mean_impute_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 + M3: mean imputation then min-max scaling (constant column -> 0)."""
    from roadframe.operators.prep import apply_fill, apply_min_max, fit_mean, fit_min_max
    s = spark.sql(_PREP_SRC.replace("FROM lineitem", "FROM {lineitem}"), lineitem=read_table(spark, sf_dir, "lineitem"))
    cols = ["q", "d", "k"]
    f = apply_fill(s, fit_mean(s, cols))
    return apply_min_max(f, fit_min_max(f, cols))


@register("mode_impute", """
WITH s AS (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_type END AS p_type,
                  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_brand END AS p_brand FROM part),
mt AS (SELECT p_type AS v FROM s WHERE p_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, v LIMIT 1),
mb AS (SELECT p_brand AS v FROM s WHERE p_brand IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, v LIMIT 1)
SELECT p_partkey, COALESCE(p_type, (SELECT v FROM mt)) AS p_type, COALESCE(p_brand, (SELECT v FROM mb)) AS p_brand
FROM s
""")
def mode_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: NULL -> most frequent value (ties -> smallest), all columns in one job."""
    from roadframe.operators.prep import apply_fill, fit_mode
    p = read_table(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_partkey") % 7 == 0, F.lit(None)).otherwise(F.col("p_type")).alias("p_type"),
        F.when(F.col("p_partkey") % 5 == 0, F.lit(None)).otherwise(F.col("p_brand")).alias("p_brand"))
    return apply_fill(p, fit_mode(p, ["p_type", "p_brand"]))


_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@register("one_hot_drop_first", "SELECT p_partkey, " + ", ".join(
    f"CASE WHEN t = '{t}' THEN 1.0 ELSE 0.0 END AS p_type_{t}" for t in [*_TYPES[1:], "nan"])
    + " FROM (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 'UNSEEN' WHEN p_partkey % 11 = 0 THEN 'nan' ELSE p_type END AS t FROM part) x")
def one_hot_drop_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One 0/1 column per category except the (sorted) first; unseen -> zeros, NULL -> its own category (G1).
    Categories are fitted on all rows; the rows they are applied to hold a further value."""
    from roadframe.operators.prep import apply_one_hot, fit_categories
    p = read_table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 11 != 0, F.col("p_type")).alias("p_type"))
    cats = fit_categories(p, ["p_type"], null_as="nan")
    seen = p.withColumn("p_type", F.when(F.col("p_partkey") % 7 == 0, F.lit("UNSEEN")).otherwise(F.col("p_type")))
    out, _ = apply_one_hot(seen, cats, null_as="nan")
    return out


_VAR_COLS = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]


@register("variance_filter", "SELECT t.\"column\", t.variance, t.variance > 0.01 AS kept FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column, var_pop(({c} - (SELECT min({c}) FROM lineitem)) / "
    f"((SELECT max({c}) FROM lineitem) - (SELECT min({c}) FROM lineitem))) AS variance FROM lineitem"
    for c in _VAR_COLS) + ") t")
def variance_filter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3d: population variance of min-max scaled features; keep those above 0.01."""
    from roadframe.operators.prep import apply_min_max, fit_min_max, variances
    li = read_table(spark, sf_dir, "lineitem").select(*_VAR_COLS)
    v = variances(apply_min_max(li, fit_min_max(li, _VAR_COLS)), _VAR_COLS)
    # one row per feature (a result of the aggregate above)
    return spark.createDataFrame([(c, float(v[c]), bool(v[c] > 0.01)) for c in _VAR_COLS],
                                 "column string, variance double, kept boolean")


@register("pca_explained_variance")
def pca_explained_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centred PCA of the embeddings; explained-variance share per
    component and cumulative (k for a 0.9 target = first cumulative > 0.9)."""
    from roadframe.operators.prep import explained_variance_table, fit_pca
    emb = read_table(spark, sf_dir, "embeddings")
    fit = fit_pca(emb, "embedding", variance=0.9)
    return explained_variance_table(fit, spark).withColumn("selected", F.col("component") <= fit.components.shape[1])


@register("pca_projection")
def pca_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9 (k = 3) and L12-style transform: centred projection of every vector."""
    from roadframe.operators.prep import fit_pca
    emb = read_table(spark, sf_dir, "embeddings")
    fit = fit_pca(emb, "embedding", k=3)
    return fit.transform(emb.select("vec_id", "embedding"), "PC").drop("embedding")


@register("lda_projection")
def lda_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary linear discriminant direction and 1-D projection."""
    from roadframe.operators.prep import fit_lda_direction, lda_project
    emb = read_table(spark, sf_dir, "embeddings").withColumn("y", (F.col("label") == 1).cast("int"))
    w = fit_lda_direction(emb, "embedding", "y")
    return lda_project(emb, "embedding", w).select("vec_id", "y", "LD1")


# --------------------------------------------------------------------------
# evaluation on a deterministic pseudo-score (SQL-checkable)
# --------------------------------------------------------------------------
_SCORED = """SELECT l_orderkey, l_discount * 10 AS score, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
  CASE WHEN l_discount * 10 >= 0.6 THEN 1 ELSE 0 END AS prediction, CAST(l_orderkey % 5 AS INTEGER) AS fold
  FROM lineitem"""


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadframe.operators.evaluate import threshold
    li = read_table(spark, sf_dir, "lineitem")
    s = li.select("l_orderkey", (F.col("l_discount") * 10).alias("score"),
                  (F.col("l_returnflag") == "R").cast("int").alias("y"),
                  (F.col("l_orderkey") % 5).cast("int").alias("fold"))
    return threshold(s, "score", 0.6, "prediction")


@register("confusion_counts", f"""
WITH s AS ({_SCORED}), g AS (SELECT a.y AS label, b.p AS prediction FROM (VALUES (0), (1)) a(y), (VALUES (0), (1)) b(p))
SELECT g.label, g.prediction, CAST(count(s.y) AS BIGINT) AS n
FROM g LEFT JOIN s ON s.y = g.label AND s.prediction = g.prediction GROUP BY 1, 2
""")
def confusion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero-filled confusion matrix at threshold 0.6."""
    from roadframe.operators.evaluate import confusion_matrix
    return confusion_matrix(_scored(spark, sf_dir), "y", "prediction", [0, 1])


@register("binary_metrics", f"""
WITH s AS ({_SCORED}),
c AS (SELECT avg(CASE WHEN y = prediction THEN 1.0 ELSE 0.0 END) AS accuracy,
             sum(CASE WHEN y = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS tp,
             sum(CASE WHEN y = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS fp,
             sum(CASE WHEN y = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS fn FROM s)
SELECT accuracy, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall,
       2 * (tp / (tp + fp)) * (tp / (tp + fn)) / ((tp / (tp + fp)) + (tp / (tp + fn))) AS f1 FROM c
""")
def binary_metrics_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy and class-1 precision / recall / F1."""
    from roadframe.operators.evaluate import binary_metrics
    return binary_metrics(_scored(spark, sf_dir), "y", "prediction")


@register("classification_report", f"""
WITH s AS ({_SCORED}),
cls AS (SELECT DISTINCT y AS c FROM s UNION SELECT DISTINCT prediction FROM s),
per AS (
  SELECT CAST(c AS VARCHAR) AS class,
         COALESCE(sum(CASE WHEN y = c AND prediction = c THEN 1 ELSE 0 END) /
                  NULLIF(sum(CASE WHEN prediction = c THEN 1 ELSE 0 END), 0), 0.0) AS precision,
         COALESCE(sum(CASE WHEN y = c AND prediction = c THEN 1 ELSE 0 END) /
                  NULLIF(sum(CASE WHEN y = c THEN 1 ELSE 0 END), 0), 0.0) AS recall,
         CAST(sum(CASE WHEN y = c THEN 1 ELSE 0 END) AS BIGINT) AS support,
         sum(CASE WHEN y = c AND prediction = c THEN 1 ELSE 0 END) AS tp
  FROM s, cls GROUP BY c),
per2 AS (SELECT *, COALESCE(2 * precision * recall / NULLIF(precision + recall, 0), 0.0) AS f1 FROM per)
SELECT class, precision, recall, f1, support FROM per2
UNION ALL SELECT 'accuracy', NULL, NULL, sum(tp) / sum(support), CAST(sum(support) AS BIGINT) FROM per2
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM per2
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                 sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per2
""")
def classification_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-class precision/recall/F1/support, accuracy, macro and weighted averages."""
    from roadframe.operators.evaluate import classification_report
    return classification_report(_scored(spark, sf_dir), "y", "prediction")


_ROC_SQL = f"""
WITH s AS ({_SCORED}),
sc AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY score),
tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM sc),
cum AS (SELECT score, sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
               sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp FROM sc),
roc AS (SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr
        UNION ALL SELECT score, fp / N, tp / P FROM cum, tot)"""


def _roc(spark, sf_dir):
    from roadframe.operators.evaluate import roc_curve
    c = roc_curve(_scored(spark, sf_dir), "y", "score")
    # the (inf, 0, 0) start point is reported with a NULL threshold
    return c.withColumn("threshold", F.when(F.col("threshold") == float("inf"), F.lit(None))
                        .otherwise(F.col("threshold")))


@register("roc_points", _ROC_SQL + "\nSELECT * FROM roc")
def roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: exact ROC points for every distinct score (distributed running sums)."""
    return _roc(spark, sf_dir)


@register("roc_auc", _ROC_SQL + """,
seg AS (SELECT fpr, tpr, lag(fpr) OVER (ORDER BY fpr, tpr) AS px, lag(tpr) OVER (ORDER BY fpr, tpr) AS py FROM roc)
SELECT COALESCE(sum((fpr - px) * (tpr + py) / 2), 0.0) AS auc FROM seg
""")
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trapezoid AUC of the exact ROC, as a sum over scores."""
    from roadframe.operators import evaluate
    return evaluate.roc_auc(_scored(spark, sf_dir), "y", "score")


@register("pr_points", f"""
WITH s AS ({_SCORED}),
sc AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY score),
tot AS (SELECT sum(pos) AS P FROM sc),
cum AS (SELECT score, sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
               sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp FROM sc)
SELECT score AS threshold, tp / (tp + fp) AS precision, tp / P AS recall FROM cum, tot
""")
def pr_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact precision-recall points."""
    from roadframe.operators.evaluate import pr_curve
    return pr_curve(_scored(spark, sf_dir), "y", "score")


@register("fold_metrics", f"""
WITH s AS ({_SCORED}),
g AS (SELECT fold, avg(CASE WHEN y = prediction THEN 1.0 ELSE 0.0 END) AS accuracy,
             CAST(sum(CASE WHEN y = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
             CAST(sum(CASE WHEN y = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
             CAST(sum(CASE WHEN y = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
             CAST(sum(CASE WHEN y = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn FROM s GROUP BY fold)
SELECT *, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall,
       2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)) AS f1 FROM g
""")
def fold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy, matrix cells and class-1 P/R/F1 per fold, one grouped job."""
    from roadframe.operators.evaluate import per_fold_metrics
    return per_fold_metrics(_scored(spark, sf_dir), "y", "prediction", "fold")


@register("fold_summary", f"""
WITH s AS ({_SCORED}),
g AS (SELECT fold, avg(CASE WHEN y = prediction THEN 1.0 ELSE 0.0 END) AS accuracy FROM s GROUP BY fold)
SELECT avg(accuracy) AS accuracy_mean, stddev_pop(accuracy) AS accuracy_std FROM g
""")
def fold_summary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and population std of per-fold accuracy."""
    from roadframe.operators.evaluate import fold_summary, per_fold_metrics
    return fold_summary(per_fold_metrics(_scored(spark, sf_dir), "y", "prediction", "fold"), ["accuracy"])


@register("summed_fold_confusion", f"""
WITH s AS ({_SCORED})
SELECT y AS label, prediction, count(DISTINCT fold) AS n_folds, count(*) AS n FROM s GROUP BY 1, 2
""")
def summed_fold_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold matrices summed cell by cell."""
    from roadframe.operators.evaluate import summed_confusion
    return summed_confusion(_scored(spark, sf_dir), "y", "prediction", "fold")


@register("mean_fold_roc", f"""
WITH s AS ({_SCORED}),
sc AS (SELECT fold, score, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY fold, score),
tot AS (SELECT fold, sum(pos) AS P, sum(neg) AS N FROM sc GROUP BY fold),
cum AS (SELECT fold, score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM sc
        WINDOW w AS (PARTITION BY fold ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
roc AS (SELECT fold, 0.0 AS fpr, 0.0 AS tpr FROM tot UNION ALL SELECT cum.fold, fp / N, tp / P FROM cum JOIN tot ON tot.fold = cum.fold),
pts AS (SELECT fold, fpr, max(tpr) AS hi, min(tpr) AS lo FROM roc GROUP BY fold, fpr),
grid AS (SELECT tot.fold, t.j, t.j / 99.0 AS g FROM tot CROSS JOIN range(100) AS t(j)),
l AS (SELECT grid.fold, grid.j, max(fpr) AS x, arg_max(hi, fpr) AS y FROM grid JOIN pts ON pts.fold = grid.fold AND fpr * 99 - 1e-12 <= grid.j GROUP BY 1, 2),
r AS (SELECT grid.fold, grid.j, min(fpr) AS x, arg_min(lo, fpr) AS y FROM grid JOIN pts ON pts.fold = grid.fold AND fpr * 99 - 1e-12 > grid.j GROUP BY 1, 2),
per AS (SELECT grid.g, CASE WHEN grid.j = 0 THEN 0.0 WHEN r.x IS NULL THEN l.y ELSE l.y + (r.y - l.y) * (grid.g - l.x) / (r.x - l.x) END AS tpr
        FROM grid JOIN l ON l.fold = grid.fold AND l.j = grid.j LEFT JOIN r ON r.fold = grid.fold AND r.j = grid.j)
SELECT g AS fpr, CASE WHEN g = 1.0 THEN 1.0 ELSE avg(tpr) END AS mean_tpr, stddev_pop(tpr) AS std_tpr FROM per GROUP BY g
""")
def mean_fold_roc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-fold ROC interpolated on 100 FPR points, averaged over folds."""
    from roadframe.operators.evaluate import mean_roc
    return mean_roc(_scored(spark, sf_dir), "y", "score", "fold", 100)


# --------------------------------------------------------------------------
# models, scoring, explanations: fitted on labelled documents, applied to all
# --------------------------------------------------------------------------
def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; label (quality) and toxic are NULL where a document has no label."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"), "toxic")
    return docs.join(lab, "doc_id", "left").withColumn("log_chars", F.log1p("n_chars"))


def prepared(train: DataFrame, *frames: DataFrame):
    """Fit fill, scaling and categories on ``train`` alone, and give every frame its feature vector."""
    from roadframe.operators.prep import apply_fill, apply_min_max, apply_one_hot, assemble, fit_categories, \
        fit_mean, fit_min_max
    num, cat = ["n_chars", "log_chars", "toxic"], ["lang", "source"]
    mean = fit_mean(train, num)
    scale = fit_min_max(apply_fill(train, mean), num)
    cats = fit_categories(train, cat)
    out = []
    for df in frames:
        df, names = apply_one_hot(apply_min_max(apply_fill(df, mean), scale), cats, keep_source=False)
        out.append(assemble(df, num + names))
    return out, num + names


def document_features(spark: SparkSession, sf_dir: str):
    """(labelled documents, all documents) with features fitted on the labelled ones, and the features' names."""
    rows = document_rows(spark, sf_dir)
    labelled = rows.filter(F.col("label").isNotNull())
    frames, feats = prepared(labelled, labelled, rows)
    return (*frames, feats)


# draws of the registered search; the operator's default is 30
SEARCH_DRAWS, SEARCH_FOLDS = 2, 5


@register("severity_model_search")
def severity_model_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split, features fitted on the training part,
    stratified folds, random search of each model with fit-time under-sampling, refit,
    threshold, metrics, save/load."""
    from multiprocessing.pool import ThreadPool

    from pyspark import inheritable_thread_target

    from roadframe.operators.evaluate import binary_metrics, threshold
    from roadframe.operators.models import (
        SearchRows, describe_model, load_model, predict_proba, random_search_cv, save_model,
    )
    from roadframe.operators.sample import stratified_folds, stratified_split
    names = ("random_forest", "logistic_regression", "gbt", "decision_tree")
    labelled = document_rows(spark, sf_dir).filter(F.col("label").isNotNull()).persist()
    held = [labelled]
    try:
        split = stratified_split(labelled, "label", 0.2, seed=42)
        train, test = (split.filter(F.col("split") == x) for x in ("train", "test"))
        (train, test), feats = prepared(train, train, test)
        train, test = stratified_folds(train.drop("split"), "label", k=SEARCH_FOLDS).persist(), test.persist()
        held += [train, test]
        parts = SearchRows.of(train, "fold", "label", seed=42)   # the same for all models
        held.append(parts)

        def search(name: str) -> list[tuple]:
            res = random_search_cv(train, "fold", [], name, "features", "label", n_iter=1 if name == "decision_tree" else SEARCH_DRAWS, seed=42, rows=parts)
            model = load_model(save_model(res.model, spark, name))
            scored = threshold(predict_proba(model, test), "p1", 0.6, "pred")
            m = binary_metrics(scored, "label", "pred").first()
            info = describe_model(model)
            return [(name, "cv_accuracy", float(res.best_score)), (name, "test_accuracy", float(m["accuracy"])),
                    (name, "num_features", float(info["numFeatures"] or len(feats)))]

        with ThreadPool(len(names)) as pool:   # while one model is refitted alone, the others' folds use the executors
            rows = [r for own in pool.map(inheritable_thread_target(spark)(search), names) for r in own]
    finally:
        for kept in held:
            kept.unpersist()
    # one row per (model, metric): results of the distributed fits above
    return spark.createDataFrame(rows, "model string, metric string, value double")


@register("adaboost_predictions")
def adaboost_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted depth-3 trees (weighted Spark trees + weight updates), 50 rounds, applied to all documents."""
    from roadframe.operators.models import adaboost, adaboost_predict
    labelled, rows, _ = document_features(spark, sf_dir)
    learners = adaboost(labelled, "features", "label", rounds=50, depth=3)
    return adaboost_predict(learners, rows, "features").select("doc_id", "label", "prediction")


@register("tree_attributions")
def tree_attributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path contributions of a random forest over all documents; global importance."""
    from pyspark.ml.classification import RandomForestClassifier

    from roadframe.operators.explain import contributions, global_importance
    labelled, rows, feats = document_features(spark, sf_dir)
    rf = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=100, maxDepth=5, seed=42).fit(labelled)
    c = contributions(rows, rf, "features", keep=["doc_id", "label"], num_features=len(feats))
    return global_importance(c, feats)


@register("top_attributions")
def top_attributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-document top-3 contributions, base + sum = score."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import vector_to_array

    from roadframe.operators.explain import contributions, top_k_contributions
    labelled, rows, feats = document_features(spark, sf_dir)
    rf = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=100, maxDepth=4, seed=7).fit(labelled)
    scored = rf.transform(rows).withColumn("p1", vector_to_array("probability")[1])
    c = contributions(scored, rf, "features", keep=["doc_id", "label", "p1", "prediction"], num_features=len(feats))
    return top_k_contributions(c, feats, 3).select("doc_id", "label", "prediction", "p1", "base", "score",
                                                   F.col("top.feature").alias("top_features"))


@register("boosted_attributions", """
SELECT 'documents' AS name, count(*) AS n FROM documents
UNION ALL SELECT 'sums that miss the raw prediction', 0 UNION ALL SELECT 'probabilities that are not of the sum', 0
UNION ALL SELECT 'base values beside the first', 0 UNION ALL SELECT 'contributions of features without a split', 0
""")
def boosted_attributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path contributions of boosted trees with categorical splits (language, source) over all documents, as counts of rows that break their sums."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    from roadframe.operators.explain import margin_contributions
    path = scratch_path(spark, "boosted-documents")
    document_rows(spark, sf_dir).fillna("", ["lang", "source"]).fillna(0, ["n_chars", "log_chars"]).write.parquet(path)
    rows = spark.read.parquet(path)
    nominal = ["lang", "source"]
    kinds = rows.agg(*[F.count_distinct(c) for c in nominal]).first()
    stages = [StringIndexer(inputCols=nominal, outputCols=[f"{c}_ix" for c in nominal], handleInvalid="keep"),
              VectorAssembler(inputCols=["n_chars", "log_chars", *(f"{c}_ix" for c in nominal)], outputCol="features"),
              GBTClassifier(featuresCol="features", labelCol="label", maxIter=20, maxDepth=4, maxBins=max(32, *(k + 1 for k in kinds)), seed=42)]
    model = Pipeline(stages=stages).fit(rows.where("label IS NOT NULL"))
    boosted = model.stages[-1]
    scored = model.transform(rows).select("doc_id", "features", vector_to_array("rawPrediction")[1].alias("margin"), vector_to_array("probability")[1].alias("p1"))
    found = margin_contributions(scored, boosted, keep=["doc_id", "margin", "p1"])
    unused = [i for i, v in enumerate(boosted.featureImportances.toArray()) if v == 0]
    out = found.agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(~(F.abs(F.col("base") + F.aggregate("contrib", F.lit(0.0), lambda a, x: a + x) - F.col("margin")) <= 1e-9)).alias("sums that miss the raw prediction"),
        F.count_if(~(F.abs(1 / (1 + F.exp(-2 * F.col("score"))) - F.col("p1")) <= 1e-9)).alias("probabilities that are not of the sum"),
        F.coalesce(F.greatest(F.count_distinct("base") - 1, F.lit(0)), F.lit(0)).alias("base values beside the first"),
        F.count_if(sum((F.col("contrib")[i] != 0).cast("int") for i in unused) > 0 if unused else F.lit(False)).alias("contributions of features without a split"))
    return out.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("long").alias("n")) for c in out.columns])))


@register("batch_scoring")
def batch_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows completed with dictionary defaults, domain-checked,
    scored with a fitted model and thresholded, with the predicted class's confidence."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler

    from roadframe import rules as R
    from roadframe.operators.models import score_batch
    from roadframe.operators.schema import columns_by_group
    from roadframe.operators.training import KEPT
    from roadframe.plans.queries_etl import user_feature_table
    path = scratch_path(spark, "user-table")   # read by every pass of the fits below
    user_feature_table(spark, sf_dir).write.parquet(path)
    feat = spark.read.parquet(path)
    ctx = [c for g in ("contexte", "usager", "vehicule") for c in columns_by_group(R.FEATURE_DICTIONARY, g) if c in feat.columns]
    cat = [c for c in ctx if R.FEATURE_DICTIONARY[c]["type"] == "categorial"]
    num = [c for c in ctx if c not in cat]
    stages = [StringIndexer(inputCols=cat, outputCols=[f"{c}_ix" for c in cat], handleInvalid="keep"),
              OneHotEncoder(inputCols=[f"{c}_ix" for c in cat], outputCols=[f"{c}_oh" for c in cat]),
              VectorAssembler(inputCols=num + [f"{c}_oh" for c in cat], outputCol="features", handleInvalid="keep")]
    from roadframe.operators.models import complete_rows
    train = complete_rows(feat.select(*ctx, F.col("grav").cast("double")), ctx, R.FEATURE_DICTIONARY)
    prepared = Pipeline(stages=stages).fit(train)
    ready = prepared.transform(train).select("features", "grav").persist(KEPT)   # the forest reads its rows several times
    try:
        forest = RandomForestClassifier(featuresCol="features", labelCol="grav", numTrees=10, maxDepth=4, seed=1).fit(ready)
    finally:
        ready.unpersist()
    model = PipelineModel(stages=[*prepared.stages, forest])
    rows = feat.select(*ctx)
    return score_batch(model, rows, ctx, R.FEATURE_DICTIONARY, t=0.5).select(
        "decision", "prediction", "confidence", F.size("violations").alias("n_violations"))
