"""Rule documents on shared storage, rule tables, run records."""

import json

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler

from roadframe import rules as R
from roadframe.functions.recode import order_dependent, recode_by_table, recode_columns, rule_table
from roadframe.operators.runs import best_model, ranked_runs, record_run, runs
from roadframe.session import scratch_path
from roadframe.sources.documents import read_dictionary, read_rules, write_document


def test_documents_round_trip(spark):
    assert read_rules(spark, write_document(spark, R.RECODE_RULES, scratch_path(spark, "doc"))) == R.RECODE_RULES
    plain = json.loads(json.dumps(R.FEATURE_DICTIONARY))
    assert read_dictionary(spark, write_document(spark, R.FEATURE_DICTIONARY, scratch_path(spark, "doc"))) == plain
    assert read_rules(spark) is R.RECODE_RULES and read_dictionary(spark) is R.FEATURE_DICTIONARY


def test_a_single_file_with_a_byte_order_mark(spark, tmp_path):
    (tmp_path / "rules.json").write_bytes(b"\xef\xbb\xbf" + json.dumps({"a": {"modalities": {"\u00e9t\u00e9": ["1"]}}}, indent=2, ensure_ascii=False).encode())
    assert read_rules(spark, str(tmp_path / "rules.json")) == {"a": {"modalities": {"\u00e9t\u00e9": ["1"]}}}


@pytest.mark.parametrize("text", ["", "{", "[1]", '{"a": 1}', '{"a": {"modalities": {"x": "1"}}}', '{"a": {"dtype": "float", "modalities": {}}}', '{"a": {"modalities": {"2": ["1"], "x": ["2"]}}}'])
def test_bad_rules_raise(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(ValueError):
        read_rules(spark, str(tmp_path / "bad.json"))


def test_bad_dictionary_raises(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"a": {"type": "text"}}')
    with pytest.raises(ValueError):
        read_dictionary(spark, str(tmp_path / "bad.json"))


def test_rule_table_equals_expressions(spark):
    rules = {"a": {"modalities": {"x": ["1", "2"], "y": ["3", "2"]}, "to_nan": ["9", "1"]}, "b": {"dtype": "int64", "modalities": {"0": ["7"], "1": ["8"]}}, "absent": {"modalities": {"z": ["1"]}}}
    rows = [("1", 7), ("2", 8), ("3", 9), ("9", None), (None, 7), ("other", 8), ("1", 7)]
    df = spark.createDataFrame(rows, "a string, b long").selectExpr("a", "b", "a AS code", "a AS label")
    got = recode_by_table(df, rule_table(spark, rules), list(rules), ["b"])
    expected = recode_columns(df, rules)
    assert got.columns == expected.columns and got.schema["b"].dataType == expected.schema["b"].dataType
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    assert recode_by_table(df.limit(0), rule_table(spark, rules), list(rules)).collect() == []


def test_order_dependent_tables_raise(spark):
    rules = {"a": {"modalities": {"2": ["1"], "x": ["2", "4"]}}, "b": {"modalities": {"x": ["2"], "2": ["1"]}}}
    table = rule_table(spark, rules)
    assert [f"{r.column}:{r.label}->{r.later}" for r in order_dependent(table).collect()] == R.validate_rules(rules) == ["a:2->x"]
    with pytest.raises(ValueError):
        recode_by_table(spark.createDataFrame([("1",)], "a string"), table, ["a"])


def test_runs_and_best_model(spark):
    folder = scratch_path(spark, "test-runs")
    assert runs(spark, folder).collect() == []
    df = spark.createDataFrame([(float(i), float(i > 20)) for i in range(40)], "x double, label double")
    models = {d: Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), DecisionTreeClassifier(maxDepth=d)]).fit(df) for d in (0, 1)}
    record_run(spark, folder, "no-model", {}, {"accuracy": 2.0})
    for _ in range(2):
        for d, m in models.items():
            right = m.transform(df).where("prediction = label").count()
            record_run(spark, folder, f"depth-{d}", {"maxDepth": d}, {"accuracy": right / 40, "other": None}, m)
    record_run(spark, folder, "broken", {}, {"accuracy": float("nan")})
    assert sorted(r.run for r in runs(spark, folder).collect()) == ["broken", "depth-0", "depth-1", "no-model"]
    assert [r.run for r in ranked_runs(runs(spark, folder), "accuracy").where("best").collect()] == ["no-model"]
    name, model = best_model(spark, folder, "accuracy")
    assert name == "depth-1" and model.transform(df).where("prediction <> label").count() == 0
    assert ranked_runs(runs(spark, folder), "other").where("best").count() == 0
    with pytest.raises(ValueError):
        best_model(spark, folder, "other")
    with pytest.raises(ValueError):
        record_run(spark, folder, "../x", {}, {})
