"""Correlation of every encoded column with a target (A11, T1), one-hot columns as rows.

A one-hot column is 0/1, so its moments follow from two counts: the rows that hold its
value and their target sum. One map-side-combined aggregate over (column, value) gives them for
all columns, however many values these have; nothing is a column of the plan, and no
value reaches the driver. Numeric columns share one plain aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA = "column string, value string, corr double, variance double"


def pearson(x: Column, y: Column) -> Column:
    """Correlation over the rows that hold both values; NULL for a constant (where ``corr`` is an error under ANSI)."""
    spread = [F.sqrt(F.var_pop(F.when(a.isNotNull() & b.isNotNull(), a))) for a, b in ((x, y), (y, x))]
    return F.try_divide(F.covar_pop(x, y), spread[0] * spread[1])


def encoded_correlations(df: DataFrame, target: str, numeric: list[str], categorical: list[str], null_as: str | None = None,
                         drop_first: bool = True, min_variance: float | None = None, top: int | None = None) -> DataFrame:
    """(column, value, corr, abs_corr, variance): Pearson of each encoded column with the target, |corr| descending.

    ``value`` is the category of a one-hot column, NULL for a numeric column. ``drop_first`` leaves out each
    column's first value in sorted order, as the encoder does; NULL is no category unless ``null_as`` names it.
    ``min_variance`` keeps columns of a population variance above it. Rows without a target take no part; a numeric
    column's NULLs neither. A constant column or target has a NULL correlation; these come last.
    """
    y = "__y"
    named = {f"__x{i}": c for i, c in enumerate([*numeric, *categorical])}
    of = {c: n for n, c in named.items()}
    base = df.select(F.col(f"`{target}`").cast("double").alias(y),
                     *[F.col(f"`{c}`").cast("double").alias(of[c]) for c in numeric],
                     *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(null_as)).alias(of[c]) for c in categorical]).filter(F.col(y).isNotNull())
    totals = base.agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("s"), F.sum(F.col(y) * F.col(y)).alias("q"),
                      *[pearson(F.col(of[c]), F.col(y)).alias(f"c{of[c]}") for c in numeric],
                      *[F.var_pop(of[c]).alias(f"v{of[c]}") for c in numeric]).first()
    # one row a numeric column: scalars of the aggregate above
    plain = df.sparkSession.createDataFrame([(c, None, totals[f"c{of[c]}"], totals[f"v{of[c]}"]) for c in numeric], SCHEMA)
    out = plain
    if categorical:
        out = plain.unionByName(_one_hot(base, y, {of[c]: c for c in categorical}, totals, drop_first))
    out = out.withColumn("corr", F.when(~F.isnan("corr"), F.col("corr"))).withColumn("abs_corr", F.abs("corr"))
    if min_variance is not None:
        out = out.filter(F.col("variance") > F.lit(min_variance))
    out = out.select("column", "value", "corr", "abs_corr", "variance").orderBy(F.col("abs_corr").desc_nulls_last(), "column", "value")
    return out.limit(top) if top else out


def _one_hot(base: DataFrame, y: str, names: dict[str, str], totals, drop_first: bool) -> DataFrame:
    cells = base.select(y, F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(x).alias("value")) for x, c in names.items()])))
    counted = cells.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(y).alias("s"))
    if drop_first:
        first = counted.groupBy("column").agg(F.min("value").alias("__first"))  # one row a column
        counted = counted.join(F.broadcast(first), "column").filter(F.col("value") != F.col("__first"))
    n, s, q = (float(totals[k] or 0) for k in "nsq")
    n = n or 1.0
    share, mean = F.col("n") / F.lit(n), F.lit(s / n)
    variance = share * (F.lit(1.0) - share)
    both = variance * F.lit(q / n - (s / n) * (s / n))
    corr = F.when(both > 0, (F.col("s") / F.lit(n) - share * mean) / F.sqrt(both))
    return counted.select("column", "value", corr.alias("corr"), variance.alias("variance"))
