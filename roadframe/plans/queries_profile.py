"""Profiling queries: NULLs, shapes, value counts, describe, correlation, domains."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadframe import rules as R
from roadframe.plans import accident_views as V
from roadframe.plans.catalog import register
from roadframe.plans.queries_etl import PROOF_CFG, _user_table_sql, accident_tables
from roadframe.session import read_table

_JOINED_COLS = ["Num_Acc", "id_vehicule", "id_usager", "place", "catu", "grav", "sexe", "an_nais", "trajet",
                "secu1", "secu2", "secu3", "locp", "actp", "catv", "obs", "obsm", "choc", "manv",
                "jour", "mois", "an", "hrmn", "lum", "dep", "agg", "int", "atm", "col",
                "catr", "circ", "vosp", "prof", "plan", "surf", "infra", "situ", "vma", "lartpc"]

_JOINED_SQL = f"""{V.duckdb_with_clause()},
j AS (
  SELECT u.Num_Acc, u.id_vehicule, u.id_usager, u.place, u.catu, u.grav, u.sexe, u.an_nais, u.trajet,
         u.secu1, u.secu2, u.secu3, u.locp, u.actp, v.catv, v.obs, v.obsm, v.choc, v.manv,
         c.jour, c.mois, c.an, c.hrmn, c.lum, c.dep, c.agg, c.int, c.atm, c.col,
         l.catr, l.circ, l.vosp, l.prof, l.plan, l.surf, l.infra, l.situ, l.vma, l.lartpc
  FROM usagers u
  LEFT JOIN vehicules v ON u.id_vehicule IS NOT DISTINCT FROM v.id_vehicule AND u.Num_Acc IS NOT DISTINCT FROM v.Num_Acc
  LEFT JOIN caracteristiques c ON u.Num_Acc IS NOT DISTINCT FROM c.Num_Acc
  LEFT JOIN lieux l ON u.Num_Acc IS NOT DISTINCT FROM l.Num_Acc)"""


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadframe.plans.etl import join_tables
    t = accident_tables(spark, sf_dir)
    return join_tables(t["usagers"], t["vehicules"], t["caracteristiques"], t["lieux"], PROOF_CFG) \
        .select(*[F.col(f"`{c}`") for c in _JOINED_COLS])


@register("joined_null_counts", _JOINED_SQL + "\nSELECT * FROM (" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null FROM j"
    for c in _JOINED_COLS) + ") t WHERE n_null > 0")
def joined_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULLs per column after the joins (positive counts only), one aggregate."""
    from roadframe.operators.profile import null_counts
    return null_counts(joined(spark, sf_dir))


@register("joined_shape", _JOINED_SQL + f"\nSELECT count(*) AS n_rows, {len(_JOINED_COLS)} AS n_columns FROM j")
def joined_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rows, columns) of the joined table."""
    from roadframe.operators.profile import shape
    return shape(joined(spark, sf_dir)).select(F.col("n_rows").cast("long"), F.col("n_columns").cast("int"))


@register("priority_value_counts", """
SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1
""")
def priority_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count per distinct value, most frequent first."""
    from roadframe.operators.profile import value_counts
    return value_counts(read_table(spark, sf_dir, "orders"), "o_orderpriority")


@register("vehicle_class_value_counts", f"""{V.duckdb_with_clause()}
SELECT {__import__('roadframe.plans.sqlgen', fromlist=['x']).sql_recode('catv', R.RECODE_RULES['catv'])} AS value,
       count(*) AS n
FROM vehicules GROUP BY 1
""")
def vehicle_class_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 after recoding: class sizes of the recoded vehicle category."""
    from roadframe.functions.recode import recode_columns
    from roadframe.operators.profile import value_counts
    t = accident_tables(spark, sf_dir)
    return value_counts(recode_columns(t["vehicules"].select("catv"), R.RECODE_RULES), "catv")


@register("part_type_distinct", "SELECT DISTINCT p_type FROM part")
def part_type_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values of a column."""
    from roadframe.operators.profile import distinct_values
    return distinct_values(read_table(spark, sf_dir, "part"), "p_type")


_DESCRIBE_NUM = ["o_totalprice", "o_custkey"]
_DESCRIBE_ALL = _DESCRIBE_NUM + ["o_orderstatus", "o_orderpriority"]


def _describe_sql() -> str:
    parts = []
    for c in _DESCRIBE_NUM:
        for stat, expr in (("count", f"count({c})"), ("mean", f"avg({c})"), ("std", f"stddev_samp({c})"),
                           ("min", f"min({c})"), ("max", f"max({c})"), ("25%", f"quantile_cont({c}, 0.25)"),
                           ("50%", f"quantile_cont({c}, 0.5)"), ("75%", f"quantile_cont({c}, 0.75)")):
            parts.append(f"SELECT '{c}' AS column, '{stat}' AS stat, CAST({expr} AS DOUBLE) AS value, "
                         f"CAST(NULL AS VARCHAR) AS text FROM orders")
    for c in _DESCRIBE_ALL:
        vc = f"(SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM orders WHERE {c} IS NOT NULL GROUP BY 1)"
        parts.append(f"SELECT '{c}', 'unique', CAST(count(*) AS DOUBLE), CAST(NULL AS VARCHAR) FROM {vc}")
        parts.append(f"SELECT '{c}', 'freq', CAST(max(n) AS DOUBLE), CAST(NULL AS VARCHAR) FROM {vc}")
        parts.append(f"SELECT '{c}', 'top', CAST(NULL AS DOUBLE), (SELECT v FROM {vc} ORDER BY n DESC, v ASC LIMIT 1)")
    return "\nUNION ALL ".join(parts)


@register("orders_describe", _describe_sql())
def orders_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: describe-style profile (exact quartiles) as a long table."""
    from roadframe.operators.profile import describe
    return describe(read_table(spark, sf_dir, "orders"), _DESCRIBE_ALL)


_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_partkey"]


@register("returnflag_correlation", "SELECT t.\"column\", t.corr, abs(t.corr) AS abs_corr FROM (" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column, corr(CAST({c} AS DOUBLE), CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) AS corr "
    f"FROM lineitem" for c in _CORR_COLS) + ") t ORDER BY abs_corr DESC LIMIT 50")
def returnflag_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pearson correlation of each column with a 0/1 label, top 50 by |corr|."""
    from roadframe.operators.profile import corr_with_target
    li = read_table(spark, sf_dir, "lineitem").withColumn(
        "label", (F.col("l_returnflag") == "R").cast("double"))
    return corr_with_target(li, _CORR_COLS, "label", top=50)


def _violations_sql() -> str:
    feats = [c for c in R.FEATURE_DICTIONARY if c in _FLAGSHIP_OUT]
    parts = []
    for c in feats:
        spec = R.FEATURE_DICTIONARY[c]
        if spec["type"] == "numerical":
            lo, hi = spec["values"]
            ok = f"{c} IN (0, 1)" if (lo, hi) == (0, 1) else f"{c} BETWEEN {lo} AND {hi}"
        else:
            vals = ", ".join("'" + str(v).replace("'", "''") + "'" for v in spec["values"])
            ok = f"{c} IN ({vals})"
        parts.append(f"SELECT '{c}' AS feature, CAST(sum(CASE WHEN COALESCE({ok}, FALSE) THEN 0 ELSE 1 END) AS BIGINT)"
                     f" AS n_violations FROM flagship")
    base = _user_table_sql()
    # wrap the flagship query as a CTE
    head, _, tail = base.rpartition("SELECT DISTINCT")
    return head.rstrip().rstrip(",") + ",\nflagship AS (SELECT DISTINCT" + tail + ")\n" + \
        "SELECT * FROM (" + "\nUNION ALL ".join(parts) + ") t WHERE n_violations > 0"


_FLAGSHIP_OUT = {"place", "catu", "sexe", "trajet", "locp", "actp", "catv", "obs", "obsm", "manv", "jour", "mois",
                 "lum", "agg", "int", "atm", "col", "catr", "circ", "vosp", "prof", "plan", "surf", "infra", "situ",
                 "vma", "nb_v", "nb_u", "imply_cycle_edp", "imply_2rm", "imply_vl", "imply_pl", "age",
                 "jour_semaine", "hr", "reg", "has_ceinture", "has_gants", "has_casque", "has_airbag", "has_gilet",
                 "has_de", "choc_avant", "choc_arriere", "choc_gauche", "choc_droit"}


@register("feature_domain_violations", _violations_sql())
def feature_domain_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain check of the feature table against the feature dictionary."""
    from roadframe.operators.profile import domain_violations
    from roadframe.plans.queries_etl import user_feature_table
    checked = domain_violations(user_feature_table(spark, sf_dir), R.FEATURE_DICTIONARY)
    return (checked.select(F.explode("violations").alias("feature"))
            .groupBy("feature").agg(F.count(F.lit(1)).alias("n_violations")))
