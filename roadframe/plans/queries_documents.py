"""Rule documents on shared storage, rule tables, and the record of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadframe import rules as R
from roadframe.plans import accident_views as V
from roadframe.plans.catalog import register
from roadframe.plans.queries_etl import accident_tables
from roadframe.plans.queries_ml import _SCORED, _scored
from roadframe.plans.sqlgen import sql_recode
from roadframe.session import scratch_path

_COLUMNS = ["lum", "agg", "int", "atm", "col"]


@register("rule_documents", f"""{V.duckdb_with_clause()},
v AS ({" UNION ALL ".join(f"SELECT '{c}' AS name, CAST({sql_recode(c, R.RECODE_RULES[c])} AS VARCHAR) AS value FROM caracteristiques" for c in _COLUMNS)})
SELECT name, value, count(*) AS n, CAST(0 AS BIGINT) AS n_differ FROM v GROUP BY name, value
""")
def rule_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule document written to shared storage, read back and applied as expressions and as a rule table; value counts, and rows where the two differ."""
    from roadframe.functions.recode import recode_by_table, recode_columns, rule_table
    from roadframe.sources.documents import read_rules, write_document
    rules = read_rules(spark, write_document(spark, R.RECODE_RULES, scratch_path(spark, "rule-document")))
    path = scratch_path(spark, "rule-table")
    rule_table(spark, {f"by_{c}": r for c, r in rules.items()}).write.parquet(path)
    rows = accident_tables(spark, sf_dir)["caracteristiques"].select(*_COLUMNS, *[F.col(c).alias(f"by_{c}") for c in _COLUMNS])
    integers = [f"by_{c}" for c in _COLUMNS if rules[c].get("dtype") == "int64"]
    both = recode_by_table(recode_columns(rows, rules), spark.read.parquet(path), [f"by_{c}" for c in _COLUMNS], integers)
    cells = both.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value"), F.col(f"by_{c}").cast("string").alias("other")) for c in _COLUMNS])))
    return cells.groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("value").eqNullSafe(F.col("other"))).alias("n_differ"))


THRESHOLDS = [0.1, 0.3, 0.5, 0.7, 0.9]


@register("run_record", f"""
WITH s AS ({_SCORED}), t AS (SELECT unnest({THRESHOLDS}) AS t),
c AS (SELECT t, count(*) FILTER (score >= t AND y = 1) AS tp, count(*) FILTER (score >= t AND y = 0) AS fp, count(*) FILTER (score < t AND y = 1) AS fn FROM s CROSS JOIN t GROUP BY t),
m AS (SELECT t, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1 FROM c)
SELECT 'threshold-' || CAST(CAST(t * 10 AS INTEGER) AS VARCHAR) AS run, precision, recall, f1, row_number() OVER (ORDER BY f1 DESC, t) = 1 AS best FROM m
""")
def run_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each decision threshold's metrics recorded as a run, twice as a restarted driver would; one row each, and the best one."""
    from roadframe.operators.runs import ranked_runs, record_run, runs
    scored, folder = _scored(spark, sf_dir), scratch_path(spark, "runs")
    up, y = [F.col("score") >= F.lit(t) for t in THRESHOLDS], F.col("y") == 1
    counts = scored.agg(*[F.count_if(x).alias(f"{n}{i}") for i, u in enumerate(up) for n, x in (("tp", u & y), ("fp", u & ~y), ("fn", ~u & y))]).first()
    for i, t in [*enumerate(THRESHOLDS)] * 2:
        tp, fp, fn = (counts[f"{n}{i}"] for n in ("tp", "fp", "fn"))
        metrics = {"precision": tp / (tp + fp) if tp + fp else None, "recall": tp / (tp + fn) if tp + fn else None, "f1": 2 * tp / (2 * tp + fp + fn) if tp + fp + fn else None}
        record_run(spark, folder, f"threshold-{round(10 * t)}", {"threshold": t}, metrics)
    names = ["precision", "recall", "f1"]
    return ranked_runs(runs(spark, folder), "f1").select("run", *[F.col("metrics")[m].alias(m) for m in names], "best")
