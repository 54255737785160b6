"""Schema operators: drop/rename if present, reference schema, conform, dtype groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DecimalType, DoubleType, FloatType, IntegerType, LongType,
    ShortType, StringType, StructType,
)

NUMERIC_TYPES = (ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType, DecimalType)


def drop_if_present(df: DataFrame, cols) -> DataFrame:
    """Drop the listed columns that exist; absent names are ignored."""
    return df.drop(*[c for c in cols if c in df.columns])


def rename_if_present(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def reference_schema(parts: dict[int, DataFrame]) -> StructType:
    """Schema of the latest part (by year key)."""
    return parts[max(parts)].schema


def conform(df: DataFrame, schema: StructType) -> tuple[DataFrame, list[str]]:
    """Keep the schema's columns in its order, add missing ones as NULL, try-cast each.

    Returns the conformed frame and the list of columns whose cast can lose
    values (source type differs from target); ``loss_report`` counts
    the values that actually became NULL, by file and column.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs, changed = [], []
    for f in schema.fields:
        if f.name in types:
            if types[f.name] != f.dataType:
                changed.append(f.name)
                exprs.append(F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name))
            else:
                exprs.append(F.col(f"`{f.name}`"))
        else:
            exprs.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*exprs), changed


def loss_report(df: DataFrame, schema: StructType, file_col: str, corrupt_col: str | None = None,
                missing_too: bool = False) -> DataFrame:
    """What ``conform`` loses, per file and column, in one pass: (file, column, reason, n_lost), positive counts only.

    ``cast``: values of ``column`` that are not NULL and fail the cast. ``malformed`` (column NULL): rows whose line
    stands in ``corrupt_col``. ``dropped``: values of a column that the schema does not have. ``missing_too`` adds
    ``missing``: rows of a file in which a column of the schema is all NULL (the file may lack it).
    The result has one row per file and affected column; nothing row-level leaves the aggregate.
    """
    types = {f.name: f.dataType for f in schema.fields}
    kept = [f for f in df.schema.fields if f.name not in (file_col, corrupt_col)]
    checks: list[tuple[str | None, str, Column]] = []
    for f in kept:
        c = F.col(f"`{f.name}`")
        if f.name not in types:
            checks.append((f.name, "dropped", F.count(c)))
            continue
        if types[f.name] != f.dataType:
            checks.append((f.name, "cast", F.count_if(c.isNotNull() & c.try_cast(types[f.name]).isNull())))
        if missing_too:
            checks.append((f.name, "missing", F.when(F.count(c) == 0, F.count(F.lit(1))).otherwise(F.lit(0))))
    if corrupt_col:
        checks.append((None, "malformed", F.count(F.col(f"`{corrupt_col}`"))))
    if missing_too:
        checks += [(n, "missing", F.count(F.lit(1))) for n in types if n not in {f.name for f in kept}]
    if not checks:
        return df.sparkSession.createDataFrame([], "file string, column string, reason string, n_lost long")
    counted = df.groupBy(F.col(f"`{file_col}`").alias("file")).agg(*[e.cast("long").alias(f"n{i}") for i, (_, _, e) in enumerate(checks)])
    return counted.select("file", F.inline(F.array(*[
        F.struct(F.lit(c).cast("string").alias("column"), F.lit(reason).alias("reason"), F.col(f"n{i}").alias("n_lost"))
        for i, (c, reason, _) in enumerate(checks)]))).filter(F.col("n_lost") > 0)


def split_by_dtype(df: DataFrame) -> tuple[list[str], list[str]]:
    """(numeric columns, categorical columns) from the schema."""
    num, cat = [], []
    for f in df.schema.fields:
        if isinstance(f.dataType, NUMERIC_TYPES):
            num.append(f.name)
        elif isinstance(f.dataType, StringType):
            cat.append(f.name)
    return num, cat


def dtypes_table(df: DataFrame) -> DataFrame:
    """(column, dtype, position) as a DataFrame."""
    rows = [(n, t, i) for i, (n, t) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "column string, dtype string, position int")


def select_in_order(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pick columns in a fixed order (missing column -> error, like a KeyError)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {missing}")
    return df.select(*[F.col(f"`{c}`") for c in cols])


def exclude_codes(df: DataFrame, col: str, codes: list) -> DataFrame:
    """Drop the rows whose ``col`` is one of ``codes``; NULLs stay."""
    return df.filter(F.col(f"`{col}`").isNull() | ~F.col(f"`{col}`").isin(codes))


def columns_by_group(dictionary: dict[str, dict], group: str) -> list[str]:
    """Feature names whose dictionary ``group`` matches (contexte/vehicule/usager)."""
    return [k for k, v in dictionary.items() if v.get("group") == group]
