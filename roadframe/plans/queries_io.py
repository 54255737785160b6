"""Source/sink queries: yearly CSV files written from the driver tables and scanned back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from roadframe.plans.catalog import register
from roadframe.session import read_table, scratch_path

MISSING_YEAR = 1997
LATIN1_YEAR = 1999
# the cut-over for file names is moved into the test window so both name forms occur
CUTOVER = 1998


def order_years(spark: SparkSession, sf_dir: str) -> list[int]:
    """The calendar years that the orders table holds."""
    years = read_table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y")).where("y IS NOT NULL").distinct()
    return sorted(r["y"] for r in years.collect())


def write_yearly_csvs(spark: SparkSession, sf_dir: str, years: list[int]) -> str:
    """Orders split into CSV files per year under the shared scratch folder:
    ';' for odd years, ',' for even years, one year in ISO-8859-1 (the accents
    may come after any number of lines), one year absent, and a column that only
    exists from 2000 on."""
    from roadframe.sources.csv_scan import yearly_path
    base = scratch_path(spark, "yearly-csv")
    o = read_table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    for y in years:
        if y == MISSING_YEAR:
            continue
        part = o.filter(F.col("year") == y).select(
            F.col("o_orderkey").alias("Accident_Id"), "o_custkey", "o_totalprice", "o_orderpriority",
            F.when(F.col("o_orderstatus") == "F", F.lit("café fermé")).otherwise(F.col("o_orderstatus")).alias("note"),
            *([F.lit(1).alias("late_col")] if y >= 2000 else []))
        (part.write.mode("overwrite").option("header", True)
         .option("sep", ";" if y % 2 else ",")
         .option("encoding", "ISO-8859-1" if y == LATIN1_YEAR else "UTF-8")
         .csv(yearly_path(base, "orders", y, CUTOVER)))
    return base


REFERENCE_SCHEMA = StructType([
    StructField("Num_Acc", LongType()), StructField("o_custkey", LongType()),
    StructField("o_totalprice", DoubleType()), StructField("o_orderpriority", StringType()),
    StructField("note", StringType()), StructField("late_col", LongType()), StructField("year", LongType()),
])


@register("csv_scan_roundtrip", f"""
SELECT year(o_orderdate) AS year, count(*) AS n_rows, round(sum(o_totalprice), 2) AS total,
       CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n_accented,
       CAST(sum(CASE WHEN year(o_orderdate) >= 2000 THEN 1 ELSE 0 END) AS BIGINT) AS n_late_col,
       count(DISTINCT o_orderkey) AS n_keys
FROM orders WHERE year(o_orderdate) <> {MISSING_YEAR}
GROUP BY 1
""")
def csv_scan_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write yearly CSVs, scan them back with probes, rename the
    key, conform to the reference schema and aggregate per year."""
    from roadframe.operators.schema import conform, rename_if_present
    from roadframe.sources.csv_scan import scan_years
    years = order_years(spark, sf_dir)
    base = write_yearly_csvs(spark, sf_dir, years)
    res = scan_years(spark, base, "orders", years, CUTOVER)
    df = rename_if_present(res.data, {"Accident_Id": "Num_Acc"})
    df, _ = conform(df, REFERENCE_SCHEMA)
    return df.groupBy("year").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.sum((F.col("note") == "café fermé").cast("long")).alias("n_accented"),
        F.count("late_col").alias("n_late_col"), F.count_distinct("Num_Acc").alias("n_keys"))


_LINE_COLUMNS = ["Accident_Id", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderdate"]


def write_faulty_csvs(spark: SparkSession, sf_dir: str, years: list[int]) -> str:
    """Orders as CSV lines per year; some lines end early or have a field too many, some prices and customers are no numbers."""
    from roadframe.sources.csv_scan import yearly_path
    base = scratch_path(spark, "faulty-csv")
    o = read_table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    key, cust = F.col("o_orderkey"), F.when(F.col("o_orderkey") % 83 == 5, F.concat(F.lit("x"), F.col("o_custkey"))).otherwise(F.col("o_custkey").cast("string"))
    price = F.when(F.col("o_custkey") % 50 == 3, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    for y in years:
        sep = ";" if y % 2 else ","
        line = F.when(key % 97 == 0, F.concat_ws(sep, key, cust)).otherwise(
            F.concat_ws(sep, key, cust, price, "o_orderpriority", F.col("o_orderdate").cast("date"), *[F.when(key % 89 == 1, F.lit("more"))]))
        # one column whose name is the header line, with a separator and a quote that no line holds
        (o.filter(F.col("year") == y).select(line.alias(sep.join(_LINE_COLUMNS))).write.mode("overwrite").option("header", True)
         .option("sep", "\u0001").option("quote", "\u0002").csv(yearly_path(base, "orders", y, CUTOVER)))
    return base


_LOSSES = {
    "NULL, 'malformed'": "o_orderkey % 97 = 0 OR o_orderkey % 89 = 1",
    "'o_custkey', 'cast'": "o_orderkey % 83 = 5",
    "'o_totalprice', 'cast'": "o_custkey % 50 = 3 AND o_orderkey % 97 <> 0",
    "'o_orderdate', 'dropped'": "o_orderkey % 97 <> 0",
}


@register("csv_loss_report", "\nUNION ALL ".join(f"""
SELECT CASE WHEN year(o_orderdate) <= {CUTOVER} THEN 'orders_' ELSE 'orders-' END || CAST(year(o_orderdate) AS VARCHAR) || '.csv' AS file,
       {names.replace(', ', ' AS "column", ')} AS reason, count(*) AS n_lost FROM orders WHERE {where} GROUP BY 1
""" for names, where in _LOSSES.items()))
def csv_loss_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What reading faulty yearly files and conforming them loses: malformed lines, failed casts and dropped columns by file."""
    from roadframe.operators.schema import loss_report, rename_if_present
    from roadframe.sources.csv_scan import scan_years
    years = order_years(spark, sf_dir)
    scan = scan_years(spark, write_faulty_csvs(spark, sf_dir, years), "orders", years, CUTOVER, corrupt_col="_line", file_col="_file")
    rows = rename_if_present(scan.data, {"Accident_Id": "Num_Acc"})
    return loss_report(rows.drop("year"), REFERENCE_SCHEMA, "_file", "_line")
