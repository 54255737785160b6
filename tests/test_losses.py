"""Loss reports, encoded correlations and policy branches on small tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from roadframe.operators.correlate import encoded_correlations
from roadframe.operators.profile import target_losses
from roadframe.operators.schema import loss_report
from roadframe.plans.etl import AccidentConfig, accident_features
from roadframe.sources.csv_scan import scan_years

SCHEMA = StructType([StructField("a", LongType()), StructField("b", DoubleType()), StructField("late", StringType())])


def test_losses_by_file_and_column(spark, tmp_path):
    (tmp_path / "t_2001.csv").write_text("a;b;old\n1;2.5;x\nno;3;y\n4\n5;6;z;more\n;bad;\n")
    (tmp_path / "t_2002.csv").write_text("a,b,late\n1,2,k\n")
    scan = scan_years(spark, str(tmp_path), "t", [2001, 2002, 2003], corrupt_col="_line", file_col="_file")
    rows = {r["a"]: r for r in scan.data.collect()}
    assert rows["4"]["_line"] == "4" and rows["5"]["_line"] == "5;6;z;more" and rows["1"]["_line"] is None
    assert rows["4"]["b"] is None and rows["5"]["old"] == "z"
    got = {tuple(r) for r in loss_report(scan.data.drop("year"), SCHEMA, "_file", "_line", missing_too=True).collect()}
    assert got == {
        ("t_2001.csv", None, "malformed", 2), ("t_2001.csv", "a", "cast", 1), ("t_2001.csv", "b", "cast", 1),
        ("t_2001.csv", "old", "dropped", 3), ("t_2001.csv", "late", "missing", 5)}


def test_losses_of_nothing(spark):
    df = spark.createDataFrame([("f", 1, 2.0, "x")], "file string, a long, b double, late string")
    assert loss_report(df, SCHEMA, "file").count() == 0
    assert loss_report(df.limit(0), SCHEMA, "file", missing_too=True).count() == 0


def test_plain_scan_has_no_further_columns(spark, tmp_path):
    (tmp_path / "t_2001.csv").write_text("a;b\n1;2\n3\n")
    scan = scan_years(spark, str(tmp_path), "t", [2001])
    assert scan.data.columns == ["a", "b", "year"] and scan.data.count() == 2


@pytest.mark.parametrize("null_as", [None, "nan"])
def test_encoded_correlations_against_numpy(spark, null_as):
    rng = np.random.default_rng(3)
    rows = [(float(rng.normal()), "abc"[rng.integers(3)] if rng.random() > 0.2 else None, "only", float(rng.integers(0, 2)), 7.0) for _ in range(300)]
    rows += [(1.0, "a", "only", None, 7.0)] * 40
    df = spark.createDataFrame(rows, "x double, c string, one string, y double, same double")
    got = {(r["column"], r["value"]): r["corr"] for r in encoded_correlations(df, "y", ["x", "same"], ["c", "one"], null_as).collect()}
    kept = [r for r in rows if r[3] is not None]
    y = np.array([r[3] for r in kept])
    want = {("x", None): np.corrcoef([r[0] for r in kept], y)[0, 1], ("same", None): None}
    for v in "bc" if null_as is None else ("b", "c", "nan"):
        want["c", v] = np.corrcoef([float((r[1] or null_as) == v) for r in kept], y)[0, 1]
    assert set(got) == set(want)
    assert all(got[k] is None if w is None else got[k] == pytest.approx(w, abs=1e-12) for k, w in want.items())


def test_encoded_correlations_keep_ranks_and_filter(spark):
    df = spark.createDataFrame([(f"v{i % 50}", float(i % 50 == 7), float(i)) for i in range(1000)], "c string, y double, x double")
    out = encoded_correlations(df, "y", ["x"], ["c"], top=3).collect()
    assert (out[0]["column"], out[0]["value"], round(out[0]["corr"], 9)) == ("c", "v7", 1.0) and len(out) == 3
    assert [r["column"] for r in encoded_correlations(df, "y", ["x"], ["c"], min_variance=0.5).collect()] == ["x"]
    assert encoded_correlations(df.limit(0), "y", ["x"], ["c"]).collect()[0]["corr"] is None


def test_classes_by_vehicles(spark):
    u = spark.createDataFrame([("A", "1", "u1"), ("A", "1", "u2"), ("A", "2", "u3"), ("B", "3", "u4"), ("C", None, "u5")], "Num_Acc string, id_vehicule string, id_usager string")
    v = spark.createDataFrame([("A", "1", "vl"), ("A", "2", "pl"), ("B", "3", "vl")], "Num_Acc string, id_vehicule string, catv string")
    places = spark.createDataFrame([("A",), ("A",), ("B",)], "Num_Acc string")
    rows = {}
    for compat in (True, False):
        cfg = AccidentConfig(compat=compat, recode_rules={}, vehicle_classes=["vl", "pl"])
        out = accident_features(u, v, places.distinct(), places, cfg).select("Num_Acc", "nb_v", "count_vl", "count_pl")
        rows[compat] = {r["Num_Acc"]: tuple(r)[1:] for r in out.collect()}
    assert rows[True] == {"A": (2, 4, 2), "B": (1, 1, 0), "C": (0, 0, 0)}
    assert rows[False] == {"A": (2, 1, 1), "B": (1, 1, 0), "C": (0, 0, 0)}


def test_target_losses(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,), (4,), (None,)], "grav int").withColumn("other", F.lit(1))
    assert {tuple(r) for r in target_losses(df, "grav", [-1]).collect()} == {("null", 2), ("code", 1), ("kept", 2)}


def test_user_table_runs_in_methods_that_the_jvm_compiles(spark):
    from roadframe.plans.queries_etl import user_feature_table
    key = "spark.sql.codegen.hugeMethodLimit"
    was = spark.conf.get(key)
    try:
        spark.conf.set(key, "65535")
        user_feature_table(spark, "/root/testdata/sf0.001")
        assert spark.conf.get(key) == "8000"
        spark.conf.set(key, "5000")  # a session's own limit stays
        user_feature_table(spark, "/root/testdata/sf0.001")
        assert spark.conf.get(key) == "5000"
    finally:
        spark.conf.set(key, was)
