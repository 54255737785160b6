"""ETL queries: joins, recoding, cleaning, group features, lookups, dedup."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from roadframe import rules as R
from roadframe.plans import accident_views as V
from roadframe.plans.catalog import register
from roadframe.plans.etl import AccidentConfig, build_user_table, preprocess
from roadframe.plans.sqlgen import sql_any_in, sql_clip, sql_pad, sql_recode

PROOF_CFG = AccidentConfig(years=V.PROOF_YEARS)


def accident_tables(spark: SparkSession, sf_dir: str, cfg: AccidentConfig = PROOF_CFG) -> dict[str, DataFrame]:
    views = V.spark_views(spark, sf_dir)
    return {p: preprocess(views[p], p, cfg) for p in R.PREFIXES} | {"regions": views["regions"]}


# --------------------------------------------------------------------------
# flagship: the whole user-level feature table
# --------------------------------------------------------------------------
_USER_COLS = ["Num_Acc", "id_vehicule", "id_usager", "place", "catu", "grav", "sexe", "an_nais",
              "trajet", "secu1", "secu2", "secu3", "locp", "actp"]
_VEH_COLS = ["catv", "obs", "obsm", "choc", "manv"]
_CAR_COLS = ["jour", "mois", "an", "hrmn", "lum", "dep", "agg", "int", "atm", "col"]
_LIEUX_COLS = ["catr", "circ", "vosp", "prof", "plan", "surf", "infra", "situ", "vma", "lartpc"]
_RECODED = [c for c in _USER_COLS + _VEH_COLS + _CAR_COLS + _LIEUX_COLS if c in R.RECODE_RULES]


def _user_table_sql(compat: bool = True) -> str:
    y0, y1 = V.PROOF_YEARS[0], V.PROOF_YEARS[-1]
    rec = ",\n  ".join(f"{sql_recode(c, R.RECODE_RULES[c])} AS {c}" for c in _RECODED)
    keep = [c for c in _USER_COLS + _VEH_COLS + _CAR_COLS + _LIEUX_COLS if c not in _RECODED]
    classes = R.VEHICLE_CLASSES
    cnt = ",\n  ".join(f"sum(CASE WHEN catv = '{x}' THEN 1 ELSE 0 END) AS count_{x}" if compat
                       else f"count(DISTINCT CASE WHEN catv = '{x}' THEN id_vehicule END) AS count_{x}" for x in classes)
    imply = ",\n  ".join(
        f"CAST(COALESCE(g.count_{x}, 0) - (CASE WHEN r.catv = '{x}' THEN 1 ELSE 0 END) > 0 AS INTEGER) AS imply_{x}"
        for x in classes)
    secu = ",\n  ".join(f"{sql_any_in(['secu1', 'secu2', 'secu3'], codes)} AS {f}" for f, codes in R.SECU_FLAGS.items())
    choc = ",\n  ".join(f"{sql_any_in(['choc'], codes)} AS {f}" for f, codes in R.CHOC_FLAGS.items())
    out_cols = [c for c in _RECODED] + [
        "grav", "nb_v", "nb_u"] + [f"imply_{x}" for x in classes] + [
        "an_nais", "an", "mois", "jour", "age", "jour_semaine", "vma", "hr", "tpc", "reg"] + \
        list(R.SECU_FLAGS) + list(R.CHOC_FLAGS)
    return f"""{V.duckdb_with_clause()},
j AS (
  SELECT u.Num_Acc, u.id_vehicule, u.id_usager, u.place, u.catu, u.grav, u.sexe, u.an_nais, u.trajet,
         u.secu1, u.secu2, u.secu3, u.locp, u.actp,
         v.catv, v.obs, v.obsm, v.choc, v.manv,
         c.jour, c.mois, c.an, c.hrmn, c.lum, c.dep, c.agg, c.int, c.atm, c.col,
         l.catr, l.circ, l.vosp, l.prof, l.plan, l.surf, l.infra, l.situ, l.vma, l.lartpc
  FROM usagers u
  LEFT JOIN vehicules v ON u.id_vehicule IS NOT DISTINCT FROM v.id_vehicule
                       AND u.Num_Acc IS NOT DISTINCT FROM v.Num_Acc
  LEFT JOIN caracteristiques c ON u.Num_Acc IS NOT DISTINCT FROM c.Num_Acc
  LEFT JOIN lieux l ON u.Num_Acc IS NOT DISTINCT FROM l.Num_Acc
),
r AS (
  SELECT {", ".join(keep)},
  {rec}
  FROM j
),
g AS (
  SELECT Num_Acc, count(DISTINCT id_vehicule) AS nb_v, count(DISTINCT id_usager) AS nb_u,
  {cnt}
  FROM r WHERE Num_Acc IS NOT NULL GROUP BY Num_Acc
),
f AS (
  SELECT r.*, g.nb_v, g.nb_u,
  {imply},
  {sql_clip('r.an_nais', R.OLDEST_YEAR, y1)} AS an_nais_c,
  r.an AS an_raw,
  {sql_clip('r.an', y0, y1)} AS an_c,
  {sql_clip('r.mois', 1, 12)} AS mois_c,
  {sql_clip('r.jour', 1, 31)} AS jour_c
  FROM r LEFT JOIN g ON r.Num_Acc = g.Num_Acc
),
m AS (SELECT median(an_nais_c) AS m_an_nais, median(an_c) AS m_an, median(mois_c) AS m_mois, median(jour_c) AS m_jour FROM f),
h AS (
  SELECT f.*,
    COALESCE(CAST(an_nais_c AS DOUBLE), m.m_an_nais) AS an_nais_f,
    COALESCE(CAST(an_c AS DOUBLE), m.m_an) AS an_f,
    COALESCE(CAST(mois_c AS DOUBLE), m.m_mois) AS mois_f,
    COALESCE(CAST(jour_c AS DOUBLE), m.{"m_mois" if compat else "m_jour"}) AS jour_f
  FROM f, m
),
k AS (
  SELECT h.*,
    CASE WHEN an_f = floor(an_f) AND mois_f = floor(mois_f) AND jour_f = floor(jour_f)
         THEN dayname(TRY_CAST(CAST(CAST(an_f AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(mois_f AS BIGINT) AS VARCHAR)
                               || '-' || CAST(CAST(jour_f AS BIGINT) AS VARCHAR) AS DATE)) END AS jour_semaine,
    CAST(an_raw - CAST(trunc(an_nais_f) AS BIGINT) AS BIGINT) AS age,
    {sql_clip('vma', None, R.VMA_CAP)} AS vma_c,
    TRY_CAST(split_part(hrmn, ':', 1) AS BIGINT) AS hr,
    CAST(CASE WHEN TRY_CAST(lartpc AS DOUBLE) IS NULL THEN {int(compat)} WHEN abs(TRY_CAST(lartpc AS DOUBLE)) <> 0 THEN 1 ELSE 0 END
         AS BIGINT) AS tpc,
    {sql_pad('dep')} AS dep_key,
    CASE WHEN grav = 4 THEN 1 WHEN grav = 3 THEN 2 ELSE grav END AS grav_c,
  {secu},
  {choc}
  FROM h
),
lk AS (SELECT {sql_pad('departement')} AS dep_key, max(region) AS reg FROM regions GROUP BY 1),
o AS (
  SELECT k.*, lk.reg FROM k LEFT JOIN lk ON k.dep_key = lk.dep_key
  WHERE k.grav_c IS NOT NULL AND k.grav_c <> -1
)
SELECT DISTINCT {", ".join(
        {"an_nais": "an_nais_f AS an_nais", "an": "an_f AS an", "mois": "mois_f AS mois",
         "jour": "jour_f AS jour", "vma": "vma_c AS vma", "grav": "grav_c - 1 AS grav"}.get(c, c)
        for c in out_cols)}
FROM o
"""


@register("user_feature_table", _user_table_sql())
def user_feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full feature plan on role-mapped tables."""
    t = accident_tables(spark, sf_dir)
    return build_user_table(t["usagers"], t["vehicules"], t["caracteristiques"], t["lieux"],
                            t["regions"], PROOF_CFG)


@register("user_feature_table_vehicles", _user_table_sql(compat=False))
def user_feature_table_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature plan without the original's oddities: classes counted by vehicles, days filled with the days' median."""
    t = accident_tables(spark, sf_dir)
    return build_user_table(t["usagers"], t["vehicules"], t["caracteristiques"], t["lieux"],
                            t["regions"], replace(PROOF_CFG, compat=False))


@register("target_losses", f"""{V.duckdb_with_clause()},
u AS (SELECT TRY_CAST(grav AS BIGINT) AS grav FROM usagers)
SELECT 'null' AS reason, count(*) - count(grav) AS n FROM u
UNION ALL SELECT 'code', count(*) FILTER (grav = -1) FROM u UNION ALL SELECT 'kept', count(*) FILTER (grav <> -1) FROM u
""")
def target_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Road users without a target, by reason."""
    from roadframe.operators.profile import target_losses as losses
    return losses(accident_tables(spark, sf_dir)["usagers"], "grav", [-1])


# --------------------------------------------------------------------------
# joins, lookups, unions, dedup, id completion
# --------------------------------------------------------------------------
@register("vehicle_two_key_join", f"""{V.duckdb_with_clause()}
SELECT u.Num_Acc, u.id_vehicule, u.id_usager, u.num_veh AS num_veh_x, v.num_veh AS num_veh_y, v.catv
FROM usagers u LEFT JOIN vehicules v
  ON u.id_vehicule IS NOT DISTINCT FROM v.id_vehicule AND u.Num_Acc IS NOT DISTINCT FROM v.Num_Acc
""")
def vehicle_two_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users ⟕ vehicles on (vehicle id, accident id), NULL-safe, clash suffixes."""
    from roadframe.operators.relate import left_join
    t = accident_tables(spark, sf_dir)
    u = t["usagers"].select("Num_Acc", "id_vehicule", "id_usager", "num_veh")
    v = t["vehicules"].select("Num_Acc", "id_vehicule", "num_veh", "catv")
    return left_join(u, v, ["id_vehicule", "Num_Acc"])


@register("accident_place_join", f"""{V.duckdb_with_clause()}
SELECT u.id_usager, u.Num_Acc, c.an, c.dep, l.catr, l.vma
FROM usagers u
LEFT JOIN caracteristiques c ON u.Num_Acc IS NOT DISTINCT FROM c.Num_Acc
LEFT JOIN lieux l ON u.Num_Acc IS NOT DISTINCT FROM l.Num_Acc
""")
def accident_place_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users ⟕ accidents ⟕ places (the place join may fan out)."""
    from roadframe.operators.relate import left_join
    t = accident_tables(spark, sf_dir)
    df = left_join(t["usagers"].select("id_usager", "Num_Acc"),
                   t["caracteristiques"].select("Num_Acc", "an", "dep"), ["Num_Acc"])
    return left_join(df, t["lieux"].select("Num_Acc", "catr", "vma"), ["Num_Acc"])


@register("department_lookup", f"""{V.duckdb_with_clause()},
lk AS (SELECT {sql_pad('departement')} AS k, max(region) AS reg FROM regions GROUP BY 1)
SELECT c.Num_Acc, c.dep, lk.reg FROM caracteristiques c LEFT JOIN lk ON {sql_pad('c.dep')} = lk.k
""")
def department_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded key -> label lookup through a size-checked broadcast."""
    from roadframe.operators.relate import lookup_join
    t = accident_tables(spark, sf_dir)
    return lookup_join(t["caracteristiques"].select("Num_Acc", "dep"), "dep",
                       t["regions"], "departement", "region", "reg")


@register("unmatched_department_report", f"""{V.duckdb_with_clause()},
lk AS (SELECT DISTINCT {sql_pad('departement')} AS k FROM regions),
miss AS (SELECT {sql_pad('c.dep')} AS dep, count(*) AS n FROM caracteristiques c
         WHERE {sql_pad('c.dep')} NOT IN (SELECT k FROM lk) GROUP BY 1),
tot AS (SELECT CAST(sum(n) AS BIGINT) AS n_total FROM miss)
SELECT dep, n, n_total FROM (SELECT * FROM miss ORDER BY n DESC, dep ASC LIMIT 10) t, tot
""")
def unmatched_department_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys missing from the lookup — total and the 10 most frequent."""
    from roadframe.operators.relate import unmatched_keys
    t = accident_tables(spark, sf_dir)
    lk = t["regions"]
    return unmatched_keys(t["caracteristiques"], "dep", lk, "departement", top=10)


def _year_slices(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    from pyspark.sql import functions as F

    from roadframe.session import read_table
    from roadframe.plans.queries_io import order_years
    o = read_table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    parts = []
    for y in order_years(spark, sf_dir):
        cols = ["o_orderkey", "o_custkey", "o_totalprice", "year"] + (["o_orderpriority"] if y >= 1998 else [])
        parts.append(o.filter(F.col("year") == y).select(*cols))
    return parts


@register("orders_year_union", """
SELECT o_orderkey, o_custkey, o_totalprice, year(o_orderdate) AS year,
       CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS o_orderpriority
FROM orders WHERE o_orderdate IS NOT NULL
""")
def orders_year_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of yearly slices by column name; a column absent in old years -> NULL."""
    from roadframe.operators.relate import union_by_name
    return union_by_name(_year_slices(spark, sf_dir))


@register("lineitem_dedup", """
SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem
""")
def lineitem_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop duplicate rows of a projection (first copy kept, NULLs equal)."""
    from roadframe.operators.relate import drop_duplicate_rows
    from roadframe.session import read_table
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return drop_duplicate_rows(li)


@register("duplicate_report", """
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST((SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem))
            AS BIGINT) AS n_distinct,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_linestatus
                                               FROM lineitem)) AS BIGINT) AS n_duplicates
FROM lineitem
""")
def duplicate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: rows, distinct rows and duplicates of a projection."""
    from roadframe.operators.profile import duplicate_rows_count
    from roadframe.session import read_table
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return duplicate_rows_count(li)


@register("event_id_fill", """
WITH e AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id END AS uid FROM events),
mx AS (SELECT COALESCE(max(uid), 0) AS m FROM e)
SELECT event_id, uid AS user_id FROM e WHERE uid IS NOT NULL
UNION ALL
SELECT event_id, m + row_number() OVER (ORDER BY event_id) AS user_id FROM e, mx WHERE uid IS NULL
""")
def event_id_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL ids -> max+1, max+2, ... (distributed zipWithIndex, no global window)."""
    from pyspark.sql import functions as F

    from roadframe.operators.relate import fill_missing_ids
    from roadframe.session import read_table
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.col("user_id")).alias("user_id"))
    return fill_missing_ids(ev, "user_id", ["event_id"])


# --------------------------------------------------------------------------
# statistics and cleaning
# --------------------------------------------------------------------------
@register("column_medians", """
SELECT 'o_totalprice' AS column_name, CAST(median(o_totalprice) AS DOUBLE) AS median FROM orders
UNION ALL SELECT 'l_extendedprice', CAST(median(l_extendedprice) AS DOUBLE) FROM lineitem
UNION ALL SELECT 'l_quantity', CAST(median(l_quantity) AS DOUBLE) FROM lineitem
UNION ALL SELECT 'c_acctbal', CAST(median(c_acctbal) AS DOUBLE) FROM customer
""")
def column_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: exact interpolated medians by bracket refinement (no global sort)."""
    from functools import reduce

    from roadframe.operators.stats import stack, stacked_medians
    from roadframe.session import read_table
    columns = {"orders": ["o_totalprice"], "lineitem": ["l_extendedprice", "l_quantity"], "customer": ["c_acctbal"]}
    stacked = reduce(DataFrame.unionAll, [stack(read_table(spark, sf_dir, t), cols) for t, cols in columns.items()])
    rows = list(stacked_medians(stacked, [c for cols in columns.values() for c in cols]).items())
    # scalar results of distributed aggregates (4 rows, one per column)
    return spark.createDataFrame(rows, "column_name string, median double")


@register("quantity_clip_median_fill", """
WITH q AS (SELECT l_orderkey, l_linenumber, l_partkey,
                  CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE l_quantity END AS q FROM lineitem),
c AS (SELECT *, CASE WHEN q < 5 THEN 5 WHEN q > 45 THEN 45 ELSE q END AS qc FROM q),
m AS (SELECT median(qc) AS m FROM c)
SELECT l_orderkey, l_linenumber, l_partkey, COALESCE(CAST(qc AS DOUBLE), m.m) AS quantity FROM c, m
""")
def quantity_clip_median_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL-keeping clip, then NULL -> exact median of the clipped column."""
    from pyspark.sql import functions as F

    from roadframe.functions.cleaning import clip
    from roadframe.operators.stats import fill_with_medians
    from roadframe.session import read_table
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        clip(F.when(F.col("l_partkey") % 9 == 0, F.lit(None)).otherwise(F.col("l_quantity")), 5, 45)
        .alias("quantity"))
    out, _ = fill_with_medians(li, ["quantity"])
    return out


_DATE_PARTS_SQL = """
SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m,
       day(o_orderdate) + (o_orderkey % 4) AS d FROM orders
"""


@register("safe_dates_weekday", f"""
WITH p AS ({_DATE_PARTS_SQL})
SELECT o_orderkey, TRY_CAST(CAST(y AS VARCHAR) || '-' || CAST(m AS VARCHAR) || '-' || CAST(d AS VARCHAR) AS DATE) AS dt,
       dayname(TRY_CAST(CAST(y AS VARCHAR) || '-' || CAST(m AS VARCHAR) || '-' || CAST(d AS VARCHAR) AS DATE)) AS weekday
FROM p
""")
def safe_dates_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(year, month, day) -> date with impossible dates -> NULL; English weekday."""
    from roadframe.functions.cleaning import safe_date, weekday_name
    from roadframe.session import read_table
    p = spark.sql(_DATE_PARTS_SQL.replace("FROM orders", "FROM {orders}"),
                  orders=read_table(spark, sf_dir, "orders"))
    return p.select("o_orderkey", safe_date("y", "m", "d").alias("dt")).withColumn("weekday", weekday_name("dt"))


@register("rejected_dates", f"""
WITH p AS ({_DATE_PARTS_SQL})
SELECT y, m, d FROM p
WHERE TRY_CAST(CAST(y AS VARCHAR) || '-' || CAST(m AS VARCHAR) || '-' || CAST(d AS VARCHAR) AS DATE) IS NULL
""")
def rejected_dates_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Side output of the rows whose date could not be assembled."""
    from roadframe.functions.cleaning import safe_date
    from roadframe.operators.profile import rejected_dates
    from roadframe.session import read_table
    p = spark.sql(_DATE_PARTS_SQL.replace("FROM orders", "FROM {orders}"),
                  orders=read_table(spark, sf_dir, "orders"))
    return rejected_dates(p.withColumn("dt", safe_date("y", "m", "d")), "dt", ["y", "m", "d"])


@register("event_hour", """
SELECT event_id, TRY_CAST(split_part(strftime(ts, '%H:%M'), ':', 1) AS BIGINT) AS hr FROM events
""")
def event_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P18: "HH:MM" text -> hour (first part of a split)."""
    from pyspark.sql import functions as F

    from roadframe.functions.cleaning import hour_from_hhmm
    from roadframe.session import read_table
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", hour_from_hhmm(F.date_format("ts", "HH:mm")).alias("hr"))


@register("value_coercions", """
WITH e AS (
  SELECT event_id, user_id,
         ' ' || CAST(user_id AS VARCHAR) || chr(160) || CAST(event_id % 10 AS VARCHAR) AS spaced_id,
         CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '0' WHEN 2 THEN '-3'
              ELSE replace(CAST(value AS VARCHAR), '.', ',') END AS width_text,
         CASE WHEN event_id % 5 = 0 THEN -1 ELSE user_id END AS code
  FROM events)
SELECT event_id,
       TRY_CAST(replace(replace(spaced_id, ' ', ''), chr(160), '') AS BIGINT) AS vehicle_id,
       TRY_CAST(width_text AS DOUBLE) AS width,
       CAST(CASE WHEN TRY_CAST(width_text AS DOUBLE) IS NULL THEN 1
                 WHEN abs(TRY_CAST(width_text AS DOUBLE)) <> 0 THEN 1 ELSE 0 END AS BIGINT) AS tpc,
       CASE WHEN code = -1 THEN NULL ELSE code END AS code
FROM e
""")
def value_coercions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unicode-space strip + numeric coerce, decimal-comma -> NULL,
    non-zero flag with NULL -> 1, sentinel -> NULL."""
    from pyspark.sql import functions as F

    from roadframe.functions.cleaning import nonzero_flag, sentinel_to_null, strip_to_long, to_number
    from roadframe.session import read_table
    ev = read_table(spark, sf_dir, "events")
    e = ev.select(
        "event_id", "user_id",
        F.concat(F.lit(" "), F.col("user_id").cast("string"), F.lit("\u00a0"),
                 (F.col("event_id") % 10).cast("string")).alias("spaced_id"),
        F.when(F.col("event_id") % 4 == 0, F.lit(None)).when(F.col("event_id") % 4 == 1, F.lit("0"))
         .when(F.col("event_id") % 4 == 2, F.lit("-3"))
         .otherwise(F.regexp_replace(F.col("value").cast("string"), r"\.", ",")).alias("width_text"),
        F.when(F.col("event_id") % 5 == 0, F.lit(-1)).otherwise(F.col("user_id")).alias("code"))
    return e.select("event_id", strip_to_long("spaced_id").alias("vehicle_id"),
                    to_number("width_text").alias("width"), nonzero_flag("width_text", 1).alias("tpc"),
                    sentinel_to_null("code", -1).alias("code"))


# --------------------------------------------------------------------------
# recoding and flags
# --------------------------------------------------------------------------
# FIXED VALUES for the proof recodes on the driver tables (not accident rules)
PRIORITY_RULE = {"dtype": "category",
                 "modalities": {"urgent": ["1-URGENT", "2-HIGH"], "normal": ["3-MEDIUM", "5-LOW"]},
                 "to_nan": ["4-NOT SPECIFIED"]}
PART_TYPE_RULE = {"dtype": "category",
                  "modalities": {"small": ["SMALL", "MEDIUM"], "large": ["LARGE"], "promo": ["PROMO"]},
                  "to_nan": ["STANDARD"]}
STATUS_RULE = {"dtype": "int64", "modalities": {"0": ["F"], "1": ["O"]}}


@register("code_recode", f"""
SELECT o_orderkey, {sql_recode('o_orderpriority', PRIORITY_RULE)} AS priority,
       {sql_recode('o_orderstatus', STATUS_RULE)} AS status
FROM orders
""")
def code_recode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N codes -> 1 label, unknown -> "-1", unlisted codes pass through, int64 rule."""
    from pyspark.sql import functions as F

    from roadframe.functions.recode import recode_columns
    from roadframe.session import read_table
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"))
    return recode_columns(o, {"priority": PRIORITY_RULE, "status": STATUS_RULE})


@register("part_type_recode", f"""
SELECT p_partkey, {sql_recode('p_type', PART_TYPE_RULE)} AS p_type FROM part
""")
def part_type_recode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6/P7 on a second table: 6 types -> 3 labels + unknown."""
    from roadframe.functions.recode import recode_columns
    from roadframe.session import read_table
    return recode_columns(read_table(spark, sf_dir, "part").select("p_partkey", "p_type"),
                          {"p_type": PART_TYPE_RULE})


@register("accident_code_recode", f"""{V.duckdb_with_clause()}
SELECT Num_Acc, {", ".join(f"{sql_recode(c, R.RECODE_RULES[c])} AS {c}" for c in
                           ["lum", "agg", "int", "atm", "col"])}
FROM caracteristiques
""")
def accident_code_recode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6-P8 with the accident rule document on the role-mapped accident table."""
    from roadframe.functions.recode import recode_columns
    t = accident_tables(spark, sf_dir)
    return recode_columns(t["caracteristiques"].select("Num_Acc", "lum", "agg", "int", "atm", "col"),
                          R.RECODE_RULES)


@register("target_collapse", f"""{V.duckdb_with_clause()}
SELECT id_usager, CASE WHEN grav = 4 THEN 1 WHEN grav = 3 THEN 2 ELSE grav END - 1 AS grav
FROM usagers WHERE grav IS NOT NULL AND grav <> -1
""")
def target_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4 -> 1, 3 -> 2, drop -1, shift to {0, 1}."""
    from roadframe.functions.recode import collapse_target
    t = accident_tables(spark, sf_dir)
    return collapse_target(t["usagers"].select("id_usager", "grav"), "grav",
                           R.GRAV_COLLAPSE, R.GRAV_DROP, R.GRAV_SHIFT)


@register("equipment_flags", f"""{V.duckdb_with_clause()}
SELECT u.id_usager, u.Num_Acc,
  {", ".join(f"{sql_any_in(['u.secu1', 'u.secu2', 'u.secu3'], c)} AS {f}" for f, c in R.SECU_FLAGS.items())},
  {", ".join(f"{sql_any_in(['v.choc'], c)} AS {f}" for f, c in R.CHOC_FLAGS.items())},
  CASE WHEN {sql_recode('v.catv', R.RECODE_RULES['catv'])} = 'vl' THEN 1 ELSE 0 END AS is_vl
FROM usagers u LEFT JOIN vehicules v ON u.id_vehicule = v.id_vehicule AND u.Num_Acc = v.Num_Acc
""")
def equipment_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any-of-three-columns membership, single-column membership, equality flag."""
    from roadframe.functions.flags import equals_flag, flag_columns
    from roadframe.functions.recode import recode
    from roadframe.operators.relate import left_join
    t = accident_tables(spark, sf_dir)
    df = left_join(t["usagers"].select("id_usager", "Num_Acc", "id_vehicule", "secu1", "secu2", "secu3"),
                   t["vehicules"].select("Num_Acc", "id_vehicule", "choc", "catv"), ["id_vehicule", "Num_Acc"],
                   null_safe=False)
    df = df.withColumns(flag_columns(R.SECU_FLAGS, ["secu1", "secu2", "secu3"]))
    df = df.withColumns(flag_columns(R.CHOC_FLAGS, "choc"))
    df = df.withColumn("is_vl", equals_flag(recode("catv", R.RECODE_RULES["catv"]), "vl"))
    return df.drop("secu1", "secu2", "secu3", "choc", "catv", "id_vehicule")


@register("order_group_features", """
WITH g AS (
  SELECT l_orderkey, count(DISTINCT l_suppkey) AS nb_v, count(DISTINCT l_partkey) AS nb_u,
         sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS count_A,
         sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS count_N,
         sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS count_R
  FROM lineitem GROUP BY l_orderkey)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_returnflag, g.nb_v, g.nb_u,
       CAST(g.count_A AS BIGINT) AS count_A, CAST(g.count_N AS BIGINT) AS count_N, CAST(g.count_R AS BIGINT) AS count_R,
       CAST(g.count_A - (CASE WHEN l.l_returnflag = 'A' THEN 1 ELSE 0 END) > 0 AS INTEGER) AS other_A,
       CAST(g.count_N - (CASE WHEN l.l_returnflag = 'N' THEN 1 ELSE 0 END) > 0 AS INTEGER) AS other_N,
       CAST(g.count_R - (CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END) > 0 AS INTEGER) AS other_R
FROM lineitem l JOIN g ON l.l_orderkey = g.l_orderkey
""")
def order_group_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, A2, P25: distinct counts, class counts and "other row of class X" per group."""
    from roadframe.operators.group import group_features
    from roadframe.session import read_table
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    return group_features(li, "l_orderkey", {"nb_v": "l_suppkey", "nb_u": "l_partkey"},
                          class_col="l_returnflag", classes=["A", "N", "R"], prefix="other_",
                          keep_counts=True)
