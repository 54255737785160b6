"""Role mapping of the driver's TPC-H-like tables onto the accident data model.

An order plays the accident, a line item the road user, ``l_suppkey`` the
vehicle and nation -> region the department -> region lookup. The codes the
accident rules expect are derived from key arithmetic, with NULLs, sentinels,
out-of-range values, impossible dates, unmatched vehicles, an unknown
department and duplicated / fanned-out place rows mixed in, so every
cleaning rule has something to do.

The derivations are written once, as SQL that both Spark and DuckDB run:
``{name}`` placeholders are bound to DataFrames on the Spark side
(``spark.sql(text, name=df)``) and to the pre-registered views in DuckDB.
This module only *builds input tables*; the operators under test run on
them afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadframe.session import read_table

# Calendar window the role-mapped accidents are processed for (orders span
# 1995-2001, so both clip bounds are exercised).
PROOF_YEARS = [1996, 1997, 1998, 1999, 2000]

USAGERS_SQL = """
SELECT l_orderkey AS Num_Acc,
       l_suppkey AS id_vehicule,
       l_partkey * 10 + l_linenumber AS id_usager,
       'V' || CAST(l_suppkey % 5 AS STRING) AS num_veh,
       l_linenumber AS place,
       (l_partkey % 3) + 1 AS catu,
       CASE WHEN l_linenumber % 5 = 0 THEN -1 ELSE l_linenumber % 5 END AS grav,
       l_partkey % 3 AS sexe,
       CASE WHEN l_partkey % 53 = 0 THEN NULL ELSE 1890 + (l_partkey % 140) END AS an_nais,
       l_partkey % 10 AS trajet,
       CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE l_linenumber END AS secu1,
       CAST(round(l_discount * 100) AS INT) % 10 AS secu2,
       CAST(round(l_tax * 100) AS INT) AS secu3,
       (l_partkey % 11) - 1 AS locp,
       CASE WHEN l_partkey % 12 = 10 THEN 'A' WHEN l_partkey % 12 = 11 THEN 'B'
            ELSE CAST(l_partkey % 12 AS STRING) END AS actp,
       l_linenumber % 3 AS etatp
FROM {lineitem}
"""

VEHICULES_SQL = """
SELECT l_orderkey AS Num_Acc,
       l_suppkey AS id_vehicule,
       'V' || CAST(min(l_linenumber) AS STRING) AS num_veh,
       l_suppkey % 16 AS catv,
       l_suppkey % 18 AS obs,
       (l_suppkey % 7) - 1 AS obsm,
       CAST(min(l_quantity) AS INT) % 10 AS choc,
       l_suppkey % 27 AS manv,
       l_suppkey % 4 AS senc,
       1 AS motor
FROM {lineitem}
WHERE (l_orderkey + l_suppkey) % 10 <> 0
GROUP BY l_orderkey, l_suppkey
"""

CARACTERISTIQUES_SQL = """
SELECT o_orderkey AS Num_Acc,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE day(o_orderdate) + (o_orderkey % 4) END AS jour,
       CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE month(o_orderdate) END AS mois,
       CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE year(o_orderdate) END AS an,
       lpad(CAST(o_custkey % 24 AS STRING), 2, '0') || ':' || lpad(CAST(o_orderkey % 60 AS STRING), 2, '0') AS hrmn,
       (o_orderkey % 7) - 1 AS lum,
       CASE WHEN o_orderkey % 31 = 0 THEN '99' ELSE CAST(c_nationkey AS STRING) END AS dep,
       'c' || CAST(o_custkey % 100 AS STRING) AS com,
       (o_orderkey % 2) + 1 AS agg,
       o_custkey % 10 AS int,
       (o_orderkey % 11) - 1 AS atm,
       (o_custkey % 8) - 1 AS col
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""

_LIEUX_BASE = """
SELECT o_orderkey AS Num_Acc,
       o_orderkey % 10 AS catr,
       (o_custkey % 5) - 1 AS circ,
       (o_orderkey % 5) - 1 AS vosp,
       (o_custkey % 6) - 1 AS prof,
       (o_orderkey % 6) - 1 AS plan,
       (o_custkey % 11) - 1 AS surf,
       o_orderkey % 10 AS infra,
       o_custkey % 9 AS situ,
       CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(round(o_totalprice) AS BIGINT) % 200 {vma_shift} END AS vma,
       CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '0' WHEN 2 THEN '-3' ELSE '5,5' END AS lartpc,
       'voie' AS voie
FROM {{orders}}
"""

# every accident once; accidents % 37 get an identical second row (removed by
# de-duplication), accidents % 41 a second row with another speed (fan-out)
LIEUX_SQL = (_LIEUX_BASE.format(vma_shift="")
             + "UNION ALL" + _LIEUX_BASE.format(vma_shift="").replace("FROM {orders}", "FROM {orders} WHERE o_orderkey % 37 = 0")
             + "UNION ALL" + _LIEUX_BASE.format(vma_shift="+ 7").replace("FROM {orders}", "FROM {orders} WHERE o_orderkey % 41 = 0"))

REGIONS_SQL = """
SELECT CAST(n_nationkey AS STRING) AS departement, r_name AS region
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
"""

VIEWS = {
    "usagers": (USAGERS_SQL, ["lineitem"]),
    "vehicules": (VEHICULES_SQL, ["lineitem"]),
    "caracteristiques": (CARACTERISTIQUES_SQL, ["orders", "customer"]),
    "lieux": (LIEUX_SQL, ["orders"]),
    "regions": (REGIONS_SQL, ["nation", "region"]),
}


def spark_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql, tables = VIEWS[name]
    read = {t: read_table(spark, sf_dir, t) for t in tables}
    if name == "vehicules":  # grouped by accident and vehicle, then joined by accident: one shuffle serves both
        read["lineitem"] = read["lineitem"].repartition("l_orderkey")
    return spark.sql(sql, **read)


def duckdb_view(name: str) -> str:
    """The same derivation for DuckDB (tables are pre-registered views)."""
    sql, tables = VIEWS[name]
    for t in tables:
        sql = sql.replace("{" + t + "}", t)
    return sql


def spark_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {n: spark_view(spark, sf_dir, n) for n in VIEWS}


def duckdb_with_clause() -> str:
    """``WITH usagers AS (...), ...`` prefix for oracle SQL."""
    return "WITH " + ",\n".join(f"{n} AS ({duckdb_view(n)})" for n in VIEWS)
