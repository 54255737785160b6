"""Lookup tables and rule documents."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from roadframe import rules as R


def read_lookup(spark: SparkSession, path: str | None = None, key: str = "departement",
                value: str = "region") -> DataFrame:
    """Department -> region lookup; validates the two required columns.

    Without ``path`` the built-in table (fixed values) is used. Keys stay
    text; zero-padding of short digit keys happens in ``lookup_join``.
    """
    if path is None:
        from roadframe.plans.etl import regions_table
        return regions_table(spark)
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    missing = [c for c in (key, value) if c not in df.columns]
    if missing:
        raise ValueError(f"lookup {path} lacks columns {missing}")
    return df.select(key, value)


def write_document(spark: SparkSession, document: dict, path: str) -> str:
    """Store a rule document or dictionary as JSON in a folder of shared storage."""
    text = json.dumps(document, ensure_ascii=False)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def read_document(spark: SparkSession, path: str) -> dict:
    """A JSON object from a file, or a folder with one file, on any storage that Spark reads."""
    texts = [r[0] for r in spark.read.text(path, wholetext=True).limit(2).collect() if r[0].strip()]
    if len(texts) != 1:
        raise ValueError(f"{path}: {'no' if not texts else 'more than one'} document")
    try:
        document = json.loads(texts[0].removeprefix("\ufeff"))
    except json.JSONDecodeError as e:
        raise ValueError(f"{path}: not JSON ({e})") from e
    if not isinstance(document, dict):
        raise ValueError(f"{path}: not an object of columns")
    return document


def read_rules(spark: SparkSession, path: str | None = None) -> dict:
    """Recode rule document (JSON); built-in rules when no path. Malformed or order-dependent rules raise."""
    if path is None:
        return R.RECODE_RULES
    rules = read_document(spark, path)
    for column, spec in rules.items():
        known = isinstance(spec, dict) and spec.get("dtype", "category") in ("category", "int64")
        lists = [*spec.get("modalities", {}).values(), spec.get("to_nan", [])] if known and isinstance(spec.get("modalities", {}), dict) else [None]
        if not all(isinstance(codes, list) for codes in lists):
            raise ValueError(f"{path}: malformed rule of {column}")
    bad = R.validate_rules(rules)
    if bad:
        raise ValueError(f"{path}: order-dependent rules: {bad}")
    return rules


def read_dictionary(spark: SparkSession, path: str | None = None) -> dict:
    """Feature dictionary (type / group / domain); built-in one when no path. Entries without a known type raise."""
    if path is None:
        return R.FEATURE_DICTIONARY
    features = read_document(spark, path)
    bad = [c for c, spec in features.items() if not isinstance(spec, dict) or spec.get("type") not in ("numerical", "categorial") or not isinstance(spec.get("values", []), list)]
    if bad:
        raise ValueError(f"{path}: malformed features {bad}")
    return features
