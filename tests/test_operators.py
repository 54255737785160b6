"""Operators on small fixtures: exact statistics, joins, ids, sampling, metrics."""

import random
import statistics

import numpy as np
from pyspark.sql import functions as F

from roadframe.operators.evaluate import auc, roc_curve
from roadframe.operators.group import group_features
from roadframe.operators.relate import drop_duplicate_rows, fill_missing_ids, left_join, lookup_join
from roadframe.operators.sample import exact_sample, stratified_folds, stratified_split, undersample
from roadframe.operators.stats import exact_medians, kth_smallest


def test_kth_smallest_refinement_matches_sort(spark):
    # force several refinement rounds with a tiny collect limit
    rnd = random.Random(3)
    vals = [rnd.random() * 1000 for _ in range(3000)] + [5.0] * 500   # a hot value
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    s = sorted(vals)
    ks = [0, 17, 1499, 1500, 2999, 3499]
    got = kth_smallest(df, "x", ks, buckets=8, max_collect=50)
    assert [got[(None, k)] for k in ks] == [s[k] for k in ks]


def test_exact_median_even_count(spark):
    # Interpolated median with an even row count, NULLs ignored
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (20.0,), (None,)], "an_nais double")
    assert exact_medians(df, ["an_nais"], max_collect=1, buckets=2)["an_nais"] == 6.0


def test_left_join_null_safe_and_suffixes(spark):
    # G14 (compat) and clash suffixes; G6 unmatched left row
    u = spark.createDataFrame([(1, None, "a"), (2, 5, "b")], "Num_Acc long, id_vehicule long, num_veh string")
    v = spark.createDataFrame([(1, None, "x")], "Num_Acc long, id_vehicule long, num_veh string")
    out = left_join(u, v, ["id_vehicule", "Num_Acc"], null_safe=True).orderBy("Num_Acc").collect()
    assert out[0]["num_veh_y"] == "x" and out[1]["num_veh_y"] is None
    strict = left_join(u, v, ["id_vehicule", "Num_Acc"]).orderBy("Num_Acc").collect()
    assert strict[0]["num_veh_y"] is None


def test_lookup_padded(spark):
    lk = spark.createDataFrame([("01", "A"), ("2A", "Corse"), ("971", "G")], "departement string, region string")
    df = spark.createDataFrame([("1",), ("2A",), ("971",), ("999",)], "dep string")
    out = [r.reg for r in lookup_join(df, "dep", lk, "departement", "region", "reg").orderBy("dep").collect()]
    assert out == ["A", "Corse", "G", None]


def test_group_features_counts(spark):
    # G13 car with two occupants; cyclist and car; NULL vehicle ids not counted
    df = spark.createDataFrame([
        (1, 10, 100, "vl"), (1, 10, 101, "vl"), (2, 20, 200, "cycle_edp"), (2, 21, 201, "vl"), (3, None, 300, None),
    ], "Num_Acc long, id_vehicule long, id_usager long, catv string")
    out = group_features(df, "Num_Acc", {"nb_v": "id_vehicule", "nb_u": "id_usager"}, "catv",
                         ["cycle_edp", "vl"]).orderBy("id_usager").collect()
    assert [r.nb_v for r in out] == [1, 1, 2, 2, 0]
    assert [r.imply_vl for r in out] == [1, 1, 1, 0, 0]
    assert [r.imply_cycle_edp for r in out] == [0, 0, 0, 1, 0]


def test_fill_missing_ids_sequence(spark):
    # max+1... in order; all-null input starts at 1
    df = spark.createDataFrame([(i, None if i % 3 == 0 else i * 10) for i in range(1, 31)], "k long, id_usager long")
    out = {r.k: r.id_usager for r in fill_missing_ids(df, "id_usager", ["k"], num_partitions=4).collect()}
    assert [out[k] for k in (3, 6, 9, 30)] == [291, 292, 293, 300]
    allnull = spark.createDataFrame([(i, None) for i in range(5)], "k long, id_usager string")
    assert sorted(r.id_usager for r in fill_missing_ids(allnull, "id_usager", ["k"]).collect()) == [1, 2, 3, 4, 5]


def test_dedup_nulls_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    assert drop_duplicate_rows(df).count() == 2


def test_exact_sampling_sizes_with_duplicates(spark):
    # identical rows tie on the hash: sizes must still be exact
    rows = [("A", 1)] * 40 + [("B", i) for i in range(25)] + [("C", i % 3) for i in range(35)]
    df = spark.createDataFrame(rows, "label string, v int")
    split = stratified_split(df, "label", 0.2, seed=7)
    sizes = {(r.label, r.split): r["count"] for r in split.groupBy("label", "split").count().collect()}
    assert sizes[("A", "test")] == 8 and sizes[("B", "test")] == 5 and sizes[("C", "test")] == 7
    us = {r.label: r["count"] for r in undersample(df, "label").groupBy("label").count().collect()}
    assert us == {"A": 25, "B": 25, "C": 25}
    folds = stratified_folds(df, "label", 5)
    fs = sorted(r["count"] for r in folds.filter(F.col("label") == "A").groupBy("fold").count().collect())
    assert fs == [8, 8, 8, 8, 8]
    assert exact_sample(df, 33).count() == 33


def test_roc_auc_matches_rank_formula(spark):
    rnd = random.Random(1)
    rows = [(rnd.randint(0, 1), round(rnd.random(), 2)) for _ in range(400)]
    df = spark.createDataFrame(rows, "y int, s double")
    a = auc(roc_curve(df, "y", "s")).first()["auc"]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    brute = statistics.fmean([1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg])
    assert abs(a - brute) < 1e-9


def test_pca_centered_variance(spark):
    from roadframe.operators.prep import fit_pca
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(200, 4)) @ np.diag([5, 2, 1, 0.1])
    df = spark.createDataFrame([(row.tolist(),) for row in x], "v array<double>")
    fit = fit_pca(df, "v", variance=0.9)
    ref = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    assert np.allclose(fit.explained_variance_ratio, ref / ref.sum(), atol=1e-8)
    assert fit.components.shape[1] == int(np.searchsorted(np.cumsum(ref / ref.sum()), 0.9, side="right") + 1)


def test_tree_contributions_add_up(spark):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.linalg import Vectors

    from roadframe.operators.explain import contributions
    rnd = random.Random(5)
    rows = []
    for _ in range(300):
        a, b = rnd.random(), rnd.random()
        rows.append((Vectors.dense([a, b]), float(a + 0.3 * b > 0.7)))
    df = spark.createDataFrame(rows, ["features", "label"])
    rf = RandomForestClassifier(numTrees=5, maxDepth=3, seed=1).fit(df)
    scored = rf.transform(df).withColumn("p1", vector_to_array("probability")[1])
    c = contributions(scored, rf, keep=["p1"], num_features=2).collect()
    assert max(abs(r.score - r.p1) for r in c) < 1e-9


def test_mean_roc_matches_numpy_interp(spark):
    from roadframe.operators.evaluate import mean_roc
    rnd = random.Random(11)
    rows = [(rnd.randint(0, 1), round(rnd.random(), 2), i % 3) for i in range(600)]
    df = spark.createDataFrame(rows, "y int, s double, fold int")
    got = {round(r.fpr, 9): r.mean_tpr for r in mean_roc(df, "y", "s", "fold", 100).collect()}
    grid = np.linspace(0, 1, 100)
    tprs = []
    for f in range(3):
        sub = [(y, s) for y, s, k in rows if k == f]
        P = sum(y for y, _ in sub)
        N = len(sub) - P
        fpr, tpr = [0.0], [0.0]
        for t in sorted({s for _, s in sub}, reverse=True):
            fpr.append(sum(1 for y, s in sub if s >= t and y == 0) / N)
            tpr.append(sum(1 for y, s in sub if s >= t and y == 1) / P)
        it = np.interp(grid, fpr, tpr)
        it[0] = 0.0
        tprs.append(it)
    ref = np.mean(tprs, axis=0)
    ref[-1] = 1.0
    assert np.allclose([got[round(g, 9)] for g in grid], ref, atol=1e-9)


def test_accident_files_hold_the_rows_of_their_year(spark):
    from pyspark.sql import functions as F
    from roadframe.plans.accident_views import spark_view
    from roadframe.plans.full_etl import _write_accident_csvs
    from roadframe.plans.queries_io import CUTOVER, order_years
    from roadframe.session import read_table
    from roadframe.sources.csv_scan import yearly_path
    folder = "/root/testdata/sf0.001"
    when = read_table(spark, folder, "orders").select(F.col("o_orderkey").alias("Num_Acc"), F.year("o_orderdate").alias("year"))
    want = {r["year"]: r["count"] for r in spark_view(spark, folder, "lieux").join(when, "Num_Acc").groupBy("year").count().collect()}
    base = _write_accident_csvs(spark, folder)
    for y in order_years(spark, folder):
        files = spark.read.option("header", True).option("sep", ";" if y % 2 else ",").csv(yearly_path(base, "lieux", y, CUTOVER))
        assert files.count() == want[y] and files.columns == spark_view(spark, folder, "lieux").columns
