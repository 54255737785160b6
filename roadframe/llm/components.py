"""Connected components of an edge table by alternating large and small stars.

Every round is two combinable minima and two joins; the edges of a round are
written to the shared folder and read back. Nothing but two numbers of a round
(edge count and checksum) reaches the driver. Rounds grow with the logarithm
of the number of nodes, not with the length of chains.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadframe.llm import common


def _mark(e: DataFrame) -> tuple:
    row = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b), either direction, repeats and loops allowed -> (node, root), root the smallest node of the component.

    Nodes without an edge to another node don't appear. No edges give no rows; null ends are ignored.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = common.stage(e, "edges")
    mark = _mark(e)
    while mark[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        e = common.stage(small.where("u <> v").distinct(), "edges")
        before, mark = mark, _mark(e)
        if mark == before:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v"), F.col("v")).distinct())
