"""Path contributions of boosted trees and of categorical splits, against a plain walk and against Spark's own scores."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from roadframe.operators.explain import contributions, margin_contributions, node_tables
from roadframe.plans import catalog
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(7)
    kind, other, size = rng.integers(0, 9, 800), rng.integers(0, 4, 800), rng.normal(size=800)
    label = (np.isin(kind, [1, 4, 5, 8]) ^ ((size > 0.4) & (other != 2))).astype(float)
    df = spark.createDataFrame([(i, Vectors.dense([float(k), float(s), float(o)]), float(y)) for i, (k, s, o, y) in enumerate(zip(kind, size, other, label))], ["id", "raw", "label"])
    return VectorIndexer(inputCol="raw", outputCol="features", maxCategories=12).fit(df).transform(df).persist()


def plain_walk(trees, x, weights):
    """Base and contributions of one vector, node by node."""
    base, out = 0.0, [0.0] * len(x)
    for tree, w in zip(trees, weights):
        node = tree[0]
        base += w * node["prediction"]
        while node["leftChild"] >= 0:
            s = node["split"]
            value = x[s["featureIndex"]]
            left = value in s["leftCategoriesOrThreshold"] if s["numCategories"] >= 0 else value <= s["leftCategoriesOrThreshold"][0]
            child = tree[node["leftChild"] if left else node["rightChild"]]
            out[s["featureIndex"]] += w * (child["prediction"] - node["prediction"])
            node = child
    return base, out


def node_paths(model, spark):
    from roadframe.session import scratch_path
    path = scratch_path(spark, "test-nodes")
    model.save(path)
    trees = {}
    for r in spark.read.parquet(f"{path}/data").collect():
        trees.setdefault(r["treeID"], {})[r["nodeData"]["id"]] = r["nodeData"].asDict(recursive=True)
    return [trees[t] for t in sorted(trees)]


def test_boosted_contributions_by_a_plain_walk(spark, rows):
    model = GBTClassifier(maxIter=6, maxDepth=4, seed=3).fit(rows)
    assert any(t["cats"].any() for t in node_tables(spark, model, margins=True).values())
    scored = model.transform(rows).withColumn("margin", vector_to_array("rawPrediction")[1])
    got = margin_contributions(scored, model, keep=["id", "margin"]).join(rows.select("id", "features"), "id").collect()
    assert len(got) == 800
    trees = node_paths(model, spark)
    for r in got:
        base, out = plain_walk(trees, r.features.toArray().tolist(), model.treeWeights)
        assert r.score == pytest.approx(r.margin, abs=1e-9)
        assert r.base == pytest.approx(base, abs=1e-12) and r.contrib == pytest.approx(out, abs=1e-12)


def test_forest_with_categorical_splits(spark, rows):
    model = RandomForestClassifier(numTrees=8, maxDepth=5, seed=3).fit(rows)
    scored = model.transform(rows).withColumn("p1", vector_to_array("probability")[1])
    assert contributions(scored, model, keep=["p1"]).where(~(F.abs(F.col("score") - F.col("p1")) <= 1e-9)).count() == 0


def test_unknown_categories_go_where_spark_sends_them(spark, rows):
    model = GBTClassifier(maxIter=4, maxDepth=3, seed=1).fit(rows)
    odd = spark.createDataFrame([(Vectors.dense([k, s, o]),) for k in (0.0, 8.0, 9.0, 40.0, -1.0, 2.5) for s in (-1.0, 1.0, float("nan")) for o in (0.0, 3.0, 7.0)], ["features"])
    scored = model.transform(odd).withColumn("margin", vector_to_array("rawPrediction")[1])
    assert [(r.score, r.margin) for r in margin_contributions(scored, model, keep=["margin"]).collect() if abs(r.score - r.margin) > 1e-9] == []


def test_no_rows(spark, rows):
    model = GBTClassifier(maxIter=2, maxDepth=2, seed=1).fit(rows)
    assert margin_contributions(rows.where("id < 0"), model, keep=["id"]).collect() == []


def test_query(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')")
    expected = dict(con.execute(catalog.oracle_sql()["boosted_attributions"]).fetchall())
    assert {r.name: r.n for r in catalog.queries()["boosted_attributions"](spark, SMALL).collect()} == expected
