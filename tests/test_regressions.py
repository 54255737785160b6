"""Cases that once gave wrong or unbounded results."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from roadframe.operators import stats
from roadframe.operators.evaluate import auc, roc_auc, roc_curve
from roadframe.operators.explain import contributions
from roadframe.operators.prep import apply_one_hot, fit_categories
from roadframe.operators.relate import fill_missing_ids, lookup_join
from roadframe.operators.sample import stratified_folds
from roadframe.session import scratch_path
from roadframe.sources.csv_scan import scan_years


def test_hot_value_never_makes_a_large_fetch(spark, monkeypatch):
    # 99.9 % of the rows hold one value; the ranks asked for lie below it, on it and above it
    values = [float(i) / 7 for i in range(20)] + [5.0] * 40_000 + [6.0 + i for i in range(20)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    fetched = []
    one_pass = stats._pass
    monkeypatch.setattr(stats, "_pass", lambda d, cuts, g, m, r: (fetched.append(sum(c.rows for c in cuts)), one_pass(d, cuts, g, m, r))[1])
    ranks = [0, 10, 19, 20, 30_000, 40_019, 40_020, 40_039]
    got = stats.kth_smallest(df, "x", ranks, buckets=8, max_collect=50)
    assert [got[None, k] for k in ranks] == [sorted(values)[k] for k in ranks]
    assert max(fetched, default=0) <= 50


@pytest.mark.parametrize("uniform", [False, True])
def test_order_statistics_of_hashes_and_groups(spark, uniform):
    rng = np.random.default_rng(0)
    rows = [(int(g), int(v)) for g, v in zip(rng.integers(0, 3, 5000), rng.integers(-2**62, 2**62, 5000))] + [(0, 2**61 + 1)] * 3000
    df = spark.createDataFrame(rows, "g long, x long")
    by = {g: sorted(x for h, x in rows if h == g) for g in range(3)}
    ranks = {g: [0, len(v) // 2, len(v) - 1] for g, v in by.items()}
    got = stats.kth_smallest(df, "x", ranks, group_col="g", buckets=16, max_collect=40, uniform=uniform)
    assert got == {(g, k): by[g][k] for g, ks in ranks.items() for k in ks}


def test_cuts_of_hashes_come_with_counts(spark):
    # one hash holds a third of a group, so that it lies outside the window that even hashes would have
    rng = np.random.default_rng(1)
    rows = [(g, int(v)) for g in (None, "a") for v in rng.integers(-2**63, 2**63 - 1, 3000)] + [("a", -2**63 + 5)] * 1500
    df = spark.createDataFrame(rows, "g string, x long")
    by = {g: sorted(x for h, x in rows if h == g) for g in (None, "a")}
    ranks = {g: [0, 700, len(v) // 2, len(v) - 1] for g, v in by.items()}
    for limit in (20_000, 60):
        got = stats.kth_with_counts(df, "x", ranks, "g", 16, limit, hash_sizes={g: len(v) for g, v in by.items()})
        assert got == {(g, k): (by[g][k], sum(x < by[g][k] for x in by[g]), by[g].count(by[g][k])) for g, ks in ranks.items() for k in ks}


def test_medians_by_value(spark):
    df = spark.createDataFrame([(1, 5.0), (1, None), (3, 7.0), (None, 9.0)], "a long, b double")
    assert stats.medians_by_value(df, ["a", "b"]) == {"a": 1.0, "b": 7.0}
    with pytest.raises(ValueError):
        stats.medians_by_value(spark.range(100), ["id"], max_values=10)


def test_folds_of_a_class_smaller_than_k(spark):
    df = spark.createDataFrame([(i, "big") for i in range(50)] + [(100, "two"), (101, "two"), (200, None)], "id long, label string")
    folds = {}
    for r in stratified_folds(df, "label", 5).collect():
        folds.setdefault(r.label, []).append(r.fold)
    assert sorted(folds["two"]) == [2, 4] and folds[None] == [4]
    assert all(folds["big"].count(f) == 10 for f in range(5))


def test_last_of_equal_lookup_keys_counts(spark):
    lookup = spark.createDataFrame([("1", "Z", 0), ("1", "A", 1)], "departement string, region string, line int")
    df = spark.createDataFrame([("01",)], "dep string")
    assert lookup_join(df, "dep", lookup, "departement", "region", "reg", order_col="line").first()["reg"] == "A"


def test_ids_beyond_doubles(spark):
    df = spark.createDataFrame([(1, "9007199254740993"), (2, "9007199254740992"), (3, None), (4, "7.0")], "o long, id string")
    got = {r.o: r.id for r in fill_missing_ids(df, "id", ["o"]).collect()}
    assert got == {1: 9007199254740993, 2: 9007199254740992, 3: 9007199254740994, 4: 7}


def test_accent_far_into_a_latin1_file(spark, tmp_path):
    (tmp_path / "t_2001.csv").write_bytes(b"a;b\n" + b"1;x\n" * 5000 + "2;café\n".encode("latin-1"))
    (tmp_path / "t_2002.csv").write_bytes(b"a,b\n" + b"1,x\n" * 5000 + "2,café\n".encode())
    out = scan_years(spark, str(tmp_path), "t", [2001, 2002, 2003])
    assert {r.b for r in out.data.where("a = '2'").collect()} == {"café"}
    assert sorted(e for _, e in out.probes.values()) == ["ISO-8859-1", "UTF-8"] and len(out.skipped) == 1


def test_null_is_a_category_if_asked_for(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "c string")
    out, names = apply_one_hot(df, fit_categories(df, ["c"], null_as="nan"), null_as="nan")
    assert names == ["c_b", "c_nan"] and out.agg(F.sum("c_nan")).first()[0] == 1.0


def test_boosted_trees_are_refused(spark):
    df = spark.createDataFrame([(Vectors.dense([float(i)]), float(i % 2)) for i in range(40)], ["features", "label"])
    with pytest.raises(ValueError):
        contributions(df, GBTClassifier(maxIter=1).fit(df))


def test_area_as_a_sum_over_scores(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(int(i % 3), int(y), float(round(s, 2))) for i, (y, s) in enumerate(zip(rng.integers(0, 2, 600), rng.random(600)))], "f long, y int, s double")
    assert roc_auc(df, "y", "s").first()["auc"] == pytest.approx(auc(roc_curve(df, "y", "s")).first()["auc"], abs=1e-12)
    by = {r.f: r.auc for r in roc_auc(df, "y", "s", partition_col="f").collect()}
    assert by == pytest.approx({r.f: r.auc for r in auc(roc_curve(df, "y", "s", partition_col="f"), partition_col="f").collect()}, abs=1e-12)


def test_scratch_folder_follows_the_session(spark):
    assert scratch_path(spark, "x").startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))


def test_wide_rows_are_compared_as_one_text(spark):
    import datetime
    import random

    from roadframe.operators.relate import WIDE, drop_duplicate_rows
    texts = [None, "", "a", "\\", "\\e", "\\s", "\\b", "\\bs", "\\\\s", "\x1f", "a\x1f", "\x1fa", "\\e\x1f\\", "é\n "]
    r = random.Random(2)
    kinds = {"t": texts, "u": texts, "d": [None, 0.0, -0.0, 1.5, 1e300, 0.1, float("nan"), float("-inf")], "n": [None, 0, -1, 2**63 - 1, -2**63],
             "i": [None, -1, 7], "b": [None, True, False], "at": [None, datetime.date(2020, 1, 2)], "x": [None, [1.5]]}
    schema = "t string, u string, d double, n long, i int, b boolean, at date, x array<double>, " + ", ".join(f"c{j} string" for j in range(WIDE))
    rows = [(*(r.choice(v) for v in kinds.values()), *["x"] * (WIDE - 1), r.choice(["y", None])) for _ in range(300)]
    rows += [(a, b, None, None, None, None, None, None, *["x"] * WIDE) for a in texts for b in texts]
    df = spark.createDataFrame(rows * 2, schema).repartition(3)
    out = drop_duplicate_rows(df)
    assert "__row" in out._jdf.queryExecution().executedPlan().toString() and out.dtypes == df.dtypes

    def seen(frame):
        found = frame.collect()
        assert len(found) == len(set(map(repr, found)))
        return set(map(repr, found))

    assert seen(out) == seen(df.dropDuplicates())
    few = out.where("t = 'a' AND d > 1 OR u = t").withColumn("all", F.array("t", "u")).select(F.explode("all").alias("v")).where("v <> 'a'")
    assert few._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    assert "__row" not in drop_duplicate_rows(df.select("t", "d"))._jdf.queryExecution().executedPlan().toString()


def test_users_are_shuffled_once_by_accident(spark):
    import re

    from roadframe.plans.etl import build_user_table
    from roadframe.plans.queries_etl import PROOF_CFG, accident_tables
    own = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = accident_tables(spark, "/root/testdata/sf0.001")
        table = build_user_table(t["usagers"], t["vehicules"], t["caracteristiques"], t["lieux"], None, PROOF_CFG)
        plan = table._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", own)
    assert "Expand" not in plan  # a row for each distinct count
    keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert len(keys) > 5 and not [x for x in keys if "id_vehicule" in x or "id_usager" in x or "l_suppkey" in x]


def test_csv_input_leaves_no_staged_tables(spark, monkeypatch):
    import os

    from roadframe import session
    from roadframe.plans import full_etl
    made, path = [], full_etl.scratch_path
    monkeypatch.setattr(full_etl, "scratch_path", lambda s, name: (made.append(path(s, name)), made[-1])[1])
    base = full_etl._write_accident_csvs(spark, "/root/testdata/sf0.001")
    assert len(made) == 5 and [m for m in made if os.path.exists(m)] == [base]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    with pytest.raises(ValueError):
        session.drop_scratch(spark, "/tmp/other")
