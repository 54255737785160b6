"""Proof queries of small operators: row filters, heads and tails, sentinels, fold reports, picks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadframe.plans import accident_views as V
from roadframe.plans.catalog import register
from roadframe.session import read_table


@register("rows_without_code", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('P', 'O') OR o_orderstatus IS NULL")
def rows_without_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with given codes are dropped; NULLs stay."""
    from roadframe.operators.schema import exclude_codes
    return exclude_codes(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["P", "O"])


@register("event_head_tail", """
WITH e AS (SELECT event_id, event_type, row_number() OVER (ORDER BY event_id) - 1 AS i, count(*) OVER () AS n FROM events)
SELECT 'head' AS part, event_id, event_type FROM e WHERE i < 5
UNION ALL SELECT 'tail', event_id, event_type FROM e WHERE i >= n - 5
UNION ALL SELECT 'nth', event_id, event_type FROM e WHERE i = 100
""")
def event_head_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: first, last and n-th rows in an order."""
    from roadframe.operators.profile import head, nth, tail
    e = read_table(spark, sf_dir, "events").select("event_id", "event_type")
    parts = {"head": head(e, "event_id", 5), "tail": tail(e, "event_id", 5), "nth": nth(e, "event_id", 100)}
    out = [df.select(F.lit(k).alias("part"), "event_id", "event_type") for k, df in parts.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


_SENT = ["lum", "agg", "int", "atm", "col", "jour"]


@register("sentinel_columns", f"{V.duckdb_with_clause()}\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", max(CASE WHEN {c} = -1 THEN 1 ELSE 0 END) AS has_sentinel, CAST(count(*) - count({c}) AS BIGINT) AS n_null FROM caracteristiques" for c in _SENT))
def sentinel_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which columns still hold the sentinel, and their NULLs."""
    from roadframe.operators.profile import null_counts, sentinel_presence
    df = V.spark_view(spark, sf_dir, "caracteristiques").select(*_SENT)
    return sentinel_presence(df).join(null_counts(df, only_positive=False).withColumnRenamed("n_null", "n_null"), "column")


@register("null_total", f"{V.duckdb_with_clause()}\nSELECT CAST(" + " + ".join(f"count(*) - count({c})" for c in _SENT) + " AS BIGINT) AS n_null_total FROM caracteristiques")
def null_total_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULLs in the whole table."""
    from roadframe.operators.profile import null_total
    return null_total(V.spark_view(spark, sf_dir, "caracteristiques").select(*_SENT))


@register("ordered_features", "SELECT l_tax, l_discount, l_quantity, CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INTEGER) AS label FROM lineitem")
def ordered_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features in a fixed order, the label last."""
    from roadframe.operators.schema import select_in_order
    li = read_table(spark, sf_dir, "lineitem").withColumn("label", (F.col("l_returnflag") == "R").cast("int"))
    return select_in_order(li, ["l_tax", "l_discount", "l_quantity", "label"])


_FOLDS = "SELECT l_orderkey % 5 AS fold, CAST(l_discount >= 0.05 AS INTEGER) AS y, CAST(l_quantity >= 25 AS INTEGER) AS prediction FROM {lineitem}"


@register("mean_fold_report", f"""
WITH s AS ({_FOLDS.format(lineitem='lineitem')}),
c AS (SELECT DISTINCT fold, c FROM s, (SELECT 0 AS c UNION ALL SELECT 1)),
p AS (SELECT c.fold, c.c,
        COALESCE(count(*) FILTER (y = c.c AND prediction = c.c) / NULLIF(count(*) FILTER (prediction = c.c), 0), 0.0) AS pr,
        COALESCE(count(*) FILTER (y = c.c AND prediction = c.c) / NULLIF(count(*) FILTER (y = c.c), 0), 0.0) AS re,
        count(*) FILTER (y = c.c) AS n
      FROM c JOIN s ON s.fold = c.fold GROUP BY 1, 2)
SELECT CAST(c AS VARCHAR) AS class, avg(pr) AS precision, avg(re) AS recall, avg(COALESCE(2 * pr * re / NULLIF(pr + re, 0), 0.0)) AS f1, avg(n) AS support
FROM p GROUP BY c
""")
def mean_fold_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-class precision, recall, F1 and support, averaged over folds."""
    from roadframe.operators.evaluate import mean_report
    s = spark.sql(_FOLDS, lineitem=read_table(spark, sf_dir, "lineitem"))
    return mean_report(s, "y", "prediction", "fold")


@register("picked_positive", f"""
SELECT CAST(1 AS BIGINT) AS n_picked, CAST(1 AS INTEGER) AS prediction, CAST(0 AS BIGINT) AS n_wrong_flags FROM ({_FOLDS.format(lineitem='lineitem')}) WHERE prediction = 1 LIMIT 1
""")
def picked_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One random row predicted positive, with whether the prediction is right."""
    from roadframe.operators.explain import pick_positive
    s = spark.sql(_FOLDS, lineitem=read_table(spark, sf_dir, "lineitem"))
    return pick_positive(s, "y").groupBy("prediction").agg(F.count(F.lit(1)).alias("n_picked"), F.count_if(F.col("is_correct") != F.col("y")).alias("n_wrong_flags"))


_LINE_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_LINE_CATEGORICAL = ["l_returnflag", "l_linestatus", "l_shipday", "l_quantity_text"]
_LINE_VARIANCE = 0.0001
_LINES = """SELECT *, CASE WHEN l_returnflag = 'R' THEN 1.0E0 ELSE 0.0E0 END AS y, CAST(CAST(l_shipdate AS DATE) AS {text}) AS l_shipday,
       CAST(CAST(l_quantity AS INTEGER) AS {text}) AS l_quantity_text FROM {lineitem}"""


@register("encoded_correlation", f"""
WITH t AS ({_LINES.format(text='VARCHAR', lineitem='lineitem')}),
k AS ({' UNION ALL '.join(f"SELECT '{c}' AS c, {c} AS v, y FROM t WHERE {c} IS NOT NULL" for c in _LINE_CATEGORICAL)}),
a AS (SELECT CAST(count(*) AS DOUBLE) AS n, sum(y) AS s, sum(y * y) AS q FROM t),
g AS (SELECT c, v, CAST(count(*) AS DOUBLE) AS n, sum(y) AS s, row_number() OVER (PARTITION BY c ORDER BY v) AS i FROM k GROUP BY c, v),
h AS (SELECT c, v, g.n / a.n AS p, g.s / a.n AS b, a.s / a.n AS m, a.q / a.n - (a.s / a.n) * (a.s / a.n) AS vy FROM g, a WHERE i > 1),
r AS (SELECT c, v, CASE WHEN p * (1.0 - p) * vy > 0 THEN (b - p * m) / sqrt(p * (1.0 - p) * vy) END AS corr, p * (1.0 - p) AS variance FROM h
      {' '.join(f"UNION ALL SELECT '{c}', NULL, corr(CAST({c} AS DOUBLE), y), var_pop(CAST({c} AS DOUBLE)) FROM t" for c in _LINE_NUMERIC)})
SELECT c AS "column", v AS value, corr, abs(corr) AS abs_corr FROM r WHERE variance > {_LINE_VARIANCE}
""")
def encoded_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11, T1, M3d: every column of the line items, one-hot where it is a category (each ship day is a column), above a variance, against the label."""
    from roadframe.operators.correlate import encoded_correlations
    lines = spark.sql(_LINES.format(text="STRING", lineitem="{lineitem}"), lineitem=read_table(spark, sf_dir, "lineitem"))
    return encoded_correlations(lines, "y", _LINE_NUMERIC, _LINE_CATEGORICAL, min_variance=_LINE_VARIANCE).drop("variance")
