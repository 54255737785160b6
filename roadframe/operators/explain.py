"""Per-row, per-feature tree attributions (path contributions) for Spark tree models.

For every tree, the class-1 share of the training rows at each node is known
(``impurityStats``). Walking a row from root to leaf, the change of that
share at each split is credited to the split's feature; the root share is
the base value. For a forest (average of trees) ``base + sum(contrib)``
equals the predicted class-1 probability exactly. The trees of a boosted model
hold margins instead: their nodes' values are the regression means, and
``margin_contributions`` adds up to the raw prediction of class 1.

Continuous splits go left at or below their threshold; categorical splits by
a table of the categories that go left, with Spark's side for values that the
split does not know.

The node tables are read from the saved model (bounded by trees x nodes),
broadcast once, and the rows are walked in Arrow batches by
``mapInPandas`` — vectorised over the rows of a batch with NumPy, one pass
per tree level, so the work is spread over all partitions.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from roadframe.session import scratch_path


def node_tables(spark, model, margins: bool = False) -> dict[int, dict[str, np.ndarray]]:
    """{tree id: node arrays} from the saved model.

    ``feat`` (-1: leaf), ``thr``, ``left``, ``right``, ``val`` by node; a categorical split has ``cats`` > 0 categories, whose
    sides (True: left) begin at ``at`` in ``sides``, and ``other``, the side of values beyond them. ``val`` is the class-1
    share of the node's training rows or, with ``margins``, its regression mean.
    """
    if "GBT" in type(model).__name__ and not margins:  # its trees hold margins, not class shares
        raise ValueError("boosted trees hold regression statistics: use margin_contributions")
    path = scratch_path(spark, "tree-model")
    model.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "treeID" not in data.columns:          # a single decision tree
        data = data.withColumn("treeID", F.lit(0))
    rows = data.select("treeID", "nodeData.id", "nodeData.leftChild", "nodeData.rightChild", "nodeData.prediction",
                       "nodeData.impurityStats", "nodeData.split.featureIndex",
                       "nodeData.split.leftCategoriesOrThreshold", "nodeData.split.numCategories").collect()
    trees: dict[int, list] = {}
    for r in rows:
        trees.setdefault(r["treeID"], []).append(r)
    out = {}
    for tid, nodes in trees.items():
        n = max(x["id"] for x in nodes) + 1
        t = {"feat": np.full(n, -1, np.int64), "thr": np.zeros(n), "left": np.full(n, -1, np.int64), "right": np.full(n, -1, np.int64),
             "val": np.zeros(n), "cats": np.zeros(n, np.int64), "at": np.zeros(n, np.int64), "other": np.zeros(n, bool)}
        sides: list[bool] = []
        for x in nodes:
            i = x["id"]
            stats = x["impurityStats"] or [0.0, 0.0]
            tot = float(sum(stats))
            t["val"][i] = x["prediction"] if margins else (stats[1] / tot) if tot > 0 and len(stats) > 1 else 0.0
            if x["leftChild"] >= 0:
                t["feat"][i], t["left"][i], t["right"][i] = x["featureIndex"], x["leftChild"], x["rightChild"]
                known = x["numCategories"]
                if known is not None and known >= 0:
                    goes_left = {int(c) for c in x["leftCategoriesOrThreshold"]}
                    t["cats"][i], t["at"][i] = known, len(sides)
                    t["other"][i] = len(goes_left) > known // 2  # Spark keeps the smaller side and tests for membership
                    sides += [c in goes_left for c in range(known)]
                else:
                    t["thr"][i] = x["leftCategoriesOrThreshold"][0]
        out[tid] = t | {"sides": np.array(sides or [False], bool)}
    return out


def _goes_left(t: dict[str, np.ndarray], node: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whether values ``x`` go left at their nodes."""
    left = x <= t["thr"][node]
    nominal = t["cats"][node] > 0
    if nominal.any():
        at, v = node[nominal], x[nominal]
        known = (v >= 0) & (v < t["cats"][at]) & (v == np.floor(v))
        left[nominal] = np.where(known, t["sides"][t["at"][at] + np.where(known, v, 0).astype(np.int64)], t["other"][at])
    return left


def _walked(df: DataFrame, tables: dict, weights: list[float], d: int, features_col: str, keep: list[str]) -> DataFrame:
    """``keep``, base, contrib and score of every row: the weighted sum over trees of the value changes on its paths."""
    bc = df.sparkSession.sparkContext.broadcast((tables, weights, d))
    data = df.select(*keep, vector_to_array(F.col(features_col)).alias("__x"))

    def walk(batches):
        tabs, w, nf = bc.value
        for pdf in batches:
            x = np.vstack(pdf["__x"].to_numpy()) if len(pdf) else np.zeros((0, nf))
            m = x.shape[0]
            contrib = np.zeros((m, nf))
            base = 0.0
            rows = np.arange(m)
            for wt, tid in zip(w, sorted(tabs)):
                t = tabs[tid]
                node = np.zeros(m, dtype=np.int64)
                base += wt * t["val"][0]
                while True:
                    f = t["feat"][node]
                    inner = f >= 0
                    if not inner.any():
                        break
                    fi = np.where(inner, f, 0)
                    child = np.where(inner, np.where(_goes_left(t, node, x[rows, fi]), t["left"][node], t["right"][node]), node)
                    delta = (t["val"][child] - t["val"][node]) * wt
                    np.add.at(contrib, (rows[inner], fi[inner]), delta[inner])
                    node = child
            out = pdf.drop(columns=["__x"]).copy()
            out["base"] = base
            out["contrib"] = list(contrib)
            out["score"] = base + contrib.sum(axis=1)
            yield out

    schema = data.drop("__x").schema.add("base", DoubleType()).add("contrib", ArrayType(DoubleType())) \
        .add("score", DoubleType())
    return data.mapInPandas(walk, schema)


def contributions(df: DataFrame, model, features_col: str = "features", keep: list[str] | None = None,
                  num_features: int | None = None) -> DataFrame:
    """Add ``base`` (double), ``contrib`` (array<double>) and ``score`` (the class-1 probability) of a tree or forest."""
    tables = node_tables(df.sparkSession, model)
    weights = np.array(list(model.treeWeights) if hasattr(model, "treeWeights") else [1.0] * len(tables))
    return _walked(df, tables, list(weights / weights.sum()), num_features or model.numFeatures, features_col, keep or [])


def margin_contributions(df: DataFrame, model, features_col: str = "features", keep: list[str] | None = None) -> DataFrame:
    """E10 for boosted trees: as ``contributions``; ``score`` is the raw prediction (margin) of class 1."""
    tables = node_tables(df.sparkSession, model, margins=True)
    return _walked(df, tables, [float(w) for w in model.treeWeights], model.numFeatures, features_col, keep or [])


def global_importance(contrib_df: DataFrame, names: list[str]) -> DataFrame:
    """Mean |contribution| per feature, most important first."""
    arr = F.col("contrib")
    row = contrib_df.agg(*[F.avg(F.abs(arr[i])).alias(f"f{i}") for i in range(len(names))])
    long = row.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("feature"), F.col(f"f{i}").alias("importance")) for i, n in enumerate(names)
    ])).alias("s")).select("s.*")
    return long.orderBy(F.col("importance").desc(), F.col("feature"))


def top_k_contributions(contrib_df: DataFrame, names: list[str], k: int = 10) -> DataFrame:
    """Per row, the k (feature, value) pairs of largest |contribution|."""
    pairs = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("feature"), F.col("contrib").alias("value"))
    srt = F.array_sort(pairs, lambda a, b: F.when(F.abs(a["value"]) > F.abs(b["value"]), -1)
                       .when(F.abs(a["value"]) < F.abs(b["value"]), 1).otherwise(0))
    return contrib_df.withColumn("top", F.slice(srt, 1, k))


def pick_positive(scored: DataFrame, label: str, pred: str = "prediction", seed: int = 42) -> DataFrame:
    """One random row predicted 1, with whether the prediction is right."""
    from roadframe.operators.sample import exact_sample
    pos = scored.filter(F.col(pred) == 1)
    return exact_sample(pos, 1, seed).withColumn("is_correct", (F.col(label) == 1).cast("int"))
