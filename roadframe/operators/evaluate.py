"""Classification metrics as small DataFrames: matrix, report, ROC/PR, AUC,
fold averages. All curves are exact: scores are first aggregated per distinct
score (map-side combined), so the ordered running sums run over the distinct
scores only, never over all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadframe.session import cut_lineage


def threshold(df: DataFrame, score_col: str, t: float, out: str = "prediction") -> DataFrame:
    """class = 1 if score >= t."""
    return df.withColumn(out, (F.col(score_col) >= F.lit(t)).cast("int"))


def accuracy(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"))


def confusion_matrix(df: DataFrame, label: str, pred: str, classes: list | None = None) -> DataFrame:
    """(label, prediction, n) for every pair of classes, zero-filled."""
    counts = df.groupBy(F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))
    if classes is None:
        classes = sorted({r[0] for r in df.select(label).distinct().collect()} |
                         {r[0] for r in df.select(pred).distinct().collect()})
    spark = df.sparkSession
    grid = spark.createDataFrame([(a, b) for a in classes for b in classes], "label int, prediction int")
    return grid.join(F.broadcast(counts) if len(classes) <= 1000 else counts, ["label", "prediction"], "left") \
        .select("label", "prediction", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def binary_metrics(df: DataFrame, label: str, pred: str, positive=1) -> DataFrame:
    """accuracy, precision, recall, f1 of the positive class (one aggregate)."""
    y, p = F.col(label), F.col(pred)
    tp = F.sum(((y == positive) & (p == positive)).cast("long"))
    fp = F.sum(((y != positive) & (p == positive)).cast("long"))
    fn = F.sum(((y == positive) & (p != positive)).cast("long"))
    r = df.agg(F.avg((y == p).cast("double")).alias("accuracy"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))
    prec = F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double"))
    rec = F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fn")).cast("double"))
    return r.select("accuracy", prec.alias("precision"), rec.alias("recall")).withColumn(
        "f1", F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def _per_class(df: DataFrame, label: str, pred: str, keys: list[str]) -> DataFrame:
    """(keys..., class, support, predicted, tp, precision, recall, f1) from one grouped count."""
    cm = df.groupBy(*keys, F.col(label).cast("string").alias("y"), F.col(pred).cast("string").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    zero, n = F.lit(0).cast("long"), F.col("n")
    roles = cm.select(*keys, F.inline(F.array(  # a pair counts for its label and for its prediction
        F.struct(F.col("y").alias("class"), n.alias("support"), zero.alias("predicted"), F.when(F.col("y") == F.col("p"), n).otherwise(zero).alias("tp")),
        F.struct(F.col("p").alias("class"), zero.alias("support"), n.alias("predicted"), zero.alias("tp")))))
    per = roles.groupBy(*keys, "class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "tp")])
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
    per = per.withColumns({"precision": ratio("tp", "predicted"), "recall": ratio("tp", "support")})
    return per.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))


def mean_report(df: DataFrame, label: str, pred: str, fold_col: str) -> DataFrame:
    """Per-class precision, recall, f1 and support, each averaged over the folds that have the class."""
    per = _per_class(df, label, pred, [fold_col])
    return per.groupBy("class").agg(*[F.avg(c).alias(c) for c in ("precision", "recall", "f1", "support")])


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """(class, precision, recall, f1, support) per class plus 'accuracy',
    'macro avg' and 'weighted avg' rows — from one grouped count of (label, prediction)."""
    per = _per_class(df, label, pred, [])
    scores = ("precision", "recall", "f1")
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"), *[F.avg(c).alias(f"m_{c}") for c in scores],
                  *[(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(f"w_{c}") for c in scores])
    none = F.lit(None).cast("double")
    rows = {"accuracy": (none, none, F.col("tp") / F.col("n")), "macro avg": [F.col(f"m_{c}") for c in scores], "weighted avg": [F.col(f"w_{c}") for c in scores]}
    extra = tot.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("class"), *[e.alias(c) for e, c in zip(v, scores)], F.col("n").cast("long").alias("support")) for k, v in rows.items()])))
    return per.select("class", *scores, F.col("support").cast("long")).unionByName(extra.where("support IS NOT NULL"))


def _score_counts(df: DataFrame, label: str, score: str, positive=1, keys: list[str] | None = None) -> DataFrame:
    """(keys..., score, pos, neg) per distinct score — a map-side-combined aggregate, computed once
    (reliable checkpoint) for all branches that read it."""
    return cut_lineage(df.groupBy(*(keys or []), F.col(score).cast("double").alias("score")).agg(
        F.sum((F.col(label) == positive).cast("long")).alias("pos"),
        F.sum((F.col(label) != positive).cast("long")).alias("neg")))


def cumulate_desc(sc: DataFrame, keys: list[str], cols: list[str], range_rows: int = 50_000) -> DataFrame:
    """Running sums of ``cols`` over descending score, per ``keys``, without a
    single-partition window: distinct scores are cut into ranges of
    about ``range_rows`` rows (approximate quantiles), each range is summed in its own window partition,
    and a per-range offset table (at most ranges x keys rows) adds the totals
    of all higher ranges."""
    buckets = max(2, min(sc.count() // range_rows, 10_000))
    probs = [i / buckets for i in range(1, buckets)]
    qs = sc.agg(F.percentile_approx("score", probs, 10 * buckets).alias("q")).first()["q"] or []
    bounds = sorted(set(qs))
    arr = F.array(*[F.lit(float(b)) for b in bounds]) if bounds else F.array().cast("array<double>")
    b = sc.withColumn("__b", F.size(F.filter(arr, lambda x: x < F.col("score"))))
    tot = b.groupBy(*keys, "__b").agg(*[F.sum(c).alias(f"__t_{c}") for c in cols])
    wo = Window.partitionBy(*keys).orderBy(F.col("__b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(*keys, "__b", *[F.coalesce(F.sum(f"__t_{c}").over(wo), F.lit(0)).alias(f"__o_{c}")
                                      for c in cols])
    wi = Window.partitionBy(*keys, "__b").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    run = b.select(*keys, "score", "__b", *cols, *[F.sum(c).over(wi).alias(f"__r_{c}") for c in cols])
    out = run.join(F.broadcast(offs), on=[*keys, "__b"])
    return out.select(*keys, "score", *cols, *[(F.col(f"__o_{c}") + F.col(f"__r_{c}")).alias(f"cum_{c}")
                                               for c in cols])


def roc_curve(df: DataFrame, label: str, score: str, positive=1, partition_col: str | None = None) -> DataFrame:
    """Exact ROC: (threshold, fpr, tpr) for every distinct score, highest first,
    plus the (inf, 0, 0) start point. ``partition_col`` gives one curve per
    value (e.g. per fold) in the same job."""
    keys = [partition_col] if partition_col else []
    sc = _score_counts(df, label, score, positive, keys)
    totals = sc.groupBy(*keys).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    cur = cumulate_desc(sc, keys, ["pos", "neg"])
    cur = cur.join(F.broadcast(totals), on=keys) if keys else cur.crossJoin(F.broadcast(totals))
    pts = cur.select(*keys, F.col("score").alias("threshold"),
                     F.try_divide(F.col("cum_neg").cast("double"), F.col("N").cast("double")).alias("fpr"),
                     F.try_divide(F.col("cum_pos").cast("double"), F.col("P").cast("double")).alias("tpr"))
    start = totals.select(*keys, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"),
                          F.lit(0.0).alias("tpr"))
    return start.unionByName(pts)


def auc(curve: DataFrame, x: str = "fpr", y: str = "tpr", partition_col: str | None = None) -> DataFrame:
    """Trapezoid area under a curve ordered by x (then y)."""
    keys = [partition_col] if partition_col else []
    w = Window.partitionBy(*keys).orderBy(F.col(x), F.col(y))
    seg = curve.select(*keys, x, y, F.lag(x).over(w).alias("px"), F.lag(y).over(w).alias("py"))
    return seg.groupBy(*keys).agg(
        F.coalesce(F.sum((F.col(x) - F.col("px")) * (F.col(y) + F.col("py")) / 2), F.lit(0.0)).alias("auc"))


def roc_auc(df: DataFrame, label: str, score: str, positive=1, partition_col: str | None = None) -> DataFrame:
    """Area under the ROC curve. The trapezoid of a score needs only its own and the running counts,
    so the area is a sum over scores, added up per range: no window over the whole curve."""
    keys = [partition_col] if partition_col else []
    sc = _score_counts(df, label, score, positive, keys)
    totals = sc.groupBy(*keys).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    area = cumulate_desc(sc, keys, ["pos", "neg"]).groupBy(*keys).agg(
        F.sum(F.col("neg") * (2 * F.col("cum_pos") - F.col("pos"))).alias("twice"))
    both = area.join(F.broadcast(totals), on=keys) if keys else area.crossJoin(F.broadcast(totals))  # one row each
    return both.select(*keys, F.coalesce(F.try_divide(F.col("twice").cast("double"), (2 * F.col("P") * F.col("N")).cast("double")), F.lit(0.0)).alias("auc"))


def pr_curve(df: DataFrame, label: str, score: str, positive=1) -> DataFrame:
    """Exact precision-recall points (threshold, precision, recall), highest score first."""
    sc = _score_counts(df, label, score, positive)
    totals = sc.agg(F.sum("pos").alias("P"))
    cur = cumulate_desc(sc, [], ["pos", "neg"]).crossJoin(F.broadcast(totals))
    return cur.select(F.col("score").alias("threshold"),
                      (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
                      F.try_divide(F.col("cum_pos").cast("double"), F.col("P").cast("double")).alias("recall"))


def mean_roc(df: DataFrame, label: str, score: str, fold_col: str, grid_points: int = 100,
             positive=1) -> DataFrame:
    """Mean ROC over folds: each fold's TPR linearly interpolated on ``grid_points``
    FPR values in [0, 1] (first point 0, last point 1), then averaged.

    At grid value g the left point is the curve point with the largest
    fpr <= g (highest tpr on ties), the right point the one with the smallest
    fpr > g. No point is paired with every grid value: each curve point is
    reduced to the first grid index it can be a left neighbour of
    (ceil(fpr * (G - 1))) and the last it can be a right neighbour of, one
    aggregate keeps the best point per (fold, index) — at most folds x G rows —
    and forward / backward fills over the grid finish the bracketing.
    """
    g1 = grid_points - 1
    curve = roc_curve(df, label, score, positive, partition_col=fold_col)
    pts = curve.groupBy(fold_col, "fpr").agg(F.max("tpr").alias("tpr_hi"), F.min("tpr").alias("tpr_lo"))
    a = F.ceil(F.col("fpr") * g1 - F.lit(1e-12)).cast("int")
    left = (pts.withColumn("j", a).groupBy(fold_col, "j")
            .agg(F.max_by(F.struct(F.col("fpr").alias("x"), F.col("tpr_hi").alias("y")), "fpr").alias("l")))
    right = (pts.withColumn("j", a - 1).filter(F.col("j") >= 0).groupBy(fold_col, "j")
             .agg(F.min_by(F.struct(F.col("fpr").alias("x"), F.col("tpr_lo").alias("y")), "fpr").alias("r")))
    grid = (pts.select(fold_col).distinct()
            .select(fold_col, F.explode(F.sequence(F.lit(0), F.lit(g1))).alias("j")))
    w_fwd = Window.partitionBy(fold_col).orderBy("j").rowsBetween(Window.unboundedPreceding, 0)
    w_bwd = Window.partitionBy(fold_col).orderBy("j").rowsBetween(0, Window.unboundedFollowing)
    j = (grid.join(left, [fold_col, "j"], "left").join(right, [fold_col, "j"], "left")
         .select(fold_col, "j", F.last("l", ignorenulls=True).over(w_fwd).alias("l"),
                 F.first("r", ignorenulls=True).over(w_bwd).alias("r")))
    g = F.col("j") / F.lit(g1)
    lx, ly, rx, ry = F.col("l.x"), F.col("l.y"), F.col("r.x"), F.col("r.y")
    interp = F.when(rx.isNull(), ly).otherwise(ly + (ry - ly) * (g - lx) / (rx - lx))
    per = j.select(fold_col, g.cast("double").alias("g"),
                   F.when(F.col("j") == 0, F.lit(0.0)).otherwise(interp).alias("tpr"))
    mean = per.groupBy("g").agg(F.avg("tpr").alias("mean_tpr"), F.stddev_pop("tpr").alias("std_tpr"))
    return mean.select(F.col("g").alias("fpr"), "mean_tpr", "std_tpr") \
        .withColumn("mean_tpr", F.when(F.col("fpr") == 1.0, F.lit(1.0)).otherwise(F.col("mean_tpr")))


def fold_summary(metrics: DataFrame, value_cols: list[str]) -> DataFrame:
    """Mean and population std of per-fold metrics."""
    return metrics.agg(*[e for c in value_cols for e in (F.avg(c).alias(f"{c}_mean"),
                                                         F.stddev_pop(c).alias(f"{c}_std"))])


def per_fold_metrics(df: DataFrame, label: str, pred: str, fold_col: str) -> DataFrame:
    """Accuracy and class-1 precision/recall/f1 per fold in one grouped job."""
    y, p = F.col(label), F.col(pred)
    g = df.groupBy(fold_col).agg(
        F.avg((y == p).cast("double")).alias("accuracy"),
        F.sum(((y == 1) & (p == 1)).cast("long")).alias("tp"),
        F.sum(((y != 1) & (p == 1)).cast("long")).alias("fp"),
        F.sum(((y == 1) & (p != 1)).cast("long")).alias("fn"),
        F.sum(((y != 1) & (p != 1)).cast("long")).alias("tn"))
    prec = F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double"))
    rec = F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fn")).cast("double"))
    return g.withColumn("precision", prec).withColumn("recall", rec).withColumn(
        "f1", F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def summed_confusion(df: DataFrame, label: str, pred: str, fold_col: str) -> DataFrame:
    """Confusion counts summed over folds (= one matrix over all rows)."""
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(
        F.countDistinct(fold_col).alias("n_folds"), F.count(F.lit(1)).alias("n"))
