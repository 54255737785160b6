"""Joins, lookups, unions, de-duplication and id completion."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, ByteType, DoubleType, IntegerType, LongType, ShortType, StringType, StructField

from roadframe.functions.keys import pad_code
from roadframe.session import cut_lineage


def left_join(left: DataFrame, right: DataFrame, keys: list[str], null_safe: bool = False,
              suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Left equi-join on ``keys``; clashing non-key columns get suffixes.

    A row with a NULL key stays and matches nothing. ``null_safe=True`` matches
    NULL keys to NULL keys (``<=>``), as a pandas merge does: n NULL rows on the
    left and m on the right make n x m rows, so it is an opt-in.
    """
    keys = list(keys)
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    l = left.withColumnsRenamed({c: c + suffixes[0] for c in clash}) if clash else left
    r = right.withColumnsRenamed({c: c + suffixes[1] for c in clash}) if clash else right
    if not null_safe:
        return l.join(r, on=keys, how="left")
    rk = {k: f"__rk_{k}" for k in keys}
    r = r.withColumnsRenamed(rk)
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(rk[k])) for k in keys])
    return l.join(r, on=cond, how="left").drop(*rk.values())


def prepare_lookup(lookup: DataFrame, key: str, value: str, width: int = 2,
                   order_col: str | None = None) -> DataFrame:
    """Normalise lookup keys (zero-pad short digit codes) and keep one row per key.

    With ``order_col`` the row with the largest order value wins ("the last
    one"), otherwise the largest value (deterministic).
    """
    lk = lookup.select(pad_code(key, width).alias("__key"), F.col(value).alias("__value"),
                       *([F.col(order_col).alias("__ord")] if order_col else []))
    if order_col:
        return (lk.groupBy("__key").agg(F.max_by("__value", "__ord").alias("__value")))
    return lk.groupBy("__key").agg(F.max("__value").alias("__value"))


def lookup_join(df: DataFrame, key_col: str, lookup: DataFrame, lookup_key: str, lookup_value: str,
                out_col: str, width: int = 2, drop_key: bool = False, order_col: str | None = None) -> DataFrame:
    """Key -> label lookup with padded keys; a miss gives NULL.

    Of several rows with one key the last by ``order_col`` counts (without it,
    the largest value). Spark picks the join from the lookup's size.
    Normalising both sides once equals "map, and on a miss pad and map
    again": padded lookup keys can only be hit by padded data keys.
    """
    lk = prepare_lookup(lookup, lookup_key, lookup_value, width, order_col)
    out = (df.withColumn("__key", pad_code(key_col, width))
             .join(lk, on="__key", how="left")
             .withColumnRenamed("__value", out_col)
             .drop("__key"))
    return out.drop(key_col) if drop_key else out


def unmatched_keys(df: DataFrame, key_col: str, lookup: DataFrame, lookup_key: str,
                   width: int = 2, top: int = 10) -> DataFrame:
    """Keys absent from the lookup: (key, n) for the ``top`` most frequent.

    ``n_total`` on every row is the total number of unmatched rows.
    Ties are broken by key so the report is deterministic.
    """
    lk = lookup.select(pad_code(lookup_key, width).alias("__key")).distinct()
    miss = (df.select(pad_code(key_col, width).alias("__key"))
              .join(lk, on="__key", how="left_anti")
              .groupBy("__key").agg(F.count(F.lit(1)).alias("n")))
    total = miss.agg(F.sum("n").alias("n_total")).first()["n_total"] or 0   # one scalar
    top_rows = miss.orderBy(F.col("n").desc(), F.col("__key").asc_nulls_first()).limit(top)
    return top_rows.select(F.col("__key").alias(key_col), "n", F.lit(total).cast("long").alias("n_total"))


def union_by_name(dfs: list[DataFrame]) -> DataFrame:
    """Union all by column name; a column missing in a part becomes NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


#: Columns from which on rows are compared and shuffled as one text.
WIDE = 16
_SEPARATOR = "\x1f"
#: Types whose text gives the value back.
_TEXT_TYPES = (ByteType, ShortType, IntegerType, LongType, DoubleType, BooleanType)


def _is_text(f: StructField) -> bool:
    return f.dataType == StringType()


def _cell(f: StructField) -> Column:
    """The value as text without the separator; NULL is the empty text, and nothing else is."""
    x = F.col(f"`{f.name}`")
    if f.dataType == DoubleType():
        x = F.when(x == 0, F.lit(0.0)).otherwise(x)  # 0.0 and -0.0 are one value
    if _is_text(f):
        odd = (x == "") | x.contains("\\") | x.contains(_SEPARATOR)
        whole = F.replace(F.replace(x, F.lit("\\"), F.lit("\\b")), F.lit(_SEPARATOR), F.lit("\\s"))
        x = F.when(odd, F.concat(F.lit("\\e"), whole)).otherwise(x)
    return F.coalesce(x.cast("string"), F.lit(""))


def _value(cell: Column, f: StructField) -> Column:
    """The value of which ``_cell`` is the text."""
    x = F.when(cell != "", cell)
    if _is_text(f):
        whole = F.replace(F.replace(F.substr(cell, F.lit(3)), F.lit("\\s"), F.lit(_SEPARATOR)), F.lit("\\b"), F.lit("\\"))
        x = F.when(cell.startswith("\\e"), whole).otherwise(x)
    return x.cast(f.dataType)


def _distinct_texts(df: DataFrame, fields: list[StructField]) -> DataFrame:
    """The distinct rows, the columns of ``fields`` as one text on the way."""
    names = {f.name for f in fields}
    rest = [F.col(f"`{c}`") for c in df.columns if c not in names]
    texts = df.select(F.concat_ws(_SEPARATOR, *map(_cell, fields)).alias("__row"), *rest).dropDuplicates()
    cells = texts.withColumn("__row", F.split("__row", _SEPARATOR))
    values = F.struct(*[_value(F.col("__row")[i], f).alias(f.name) for i, f in enumerate(fields)])
    # a filter on a value would be put below a plain projection, and split the text again for every value it looks at
    return cells.select(F.inline(F.array(values)), *rest).select(*[F.col(f"`{c}`") for c in df.columns])


def drop_duplicate_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Keep one copy of every distinct row (NULLs compare equal).

    Implemented by Spark as an aggregate with a map-side partial step, so
    many copies of one row are merged before the shuffle. Wide rows are one
    text there: a number or text of a column of its own takes 8 to 24 bytes.
    """
    fields = [f for f in df.schema.fields if _is_text(f) or isinstance(f.dataType, _TEXT_TYPES)]
    if subset is None and len(fields) >= WIDE and len(set(df.columns)) == len(df.columns):
        return _distinct_texts(df, fields)
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def duplicate_count(df: DataFrame) -> int:
    """Rows that repeat an earlier identical row."""
    r = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("n")) \
          .agg(F.sum(F.col("n") - 1).alias("d")).first()
    return int(r["d"] or 0)


def fill_missing_ids(df: DataFrame, id_col: str, order_cols: list[str], num_partitions: int | None = None
                     ) -> DataFrame:
    """NULL ids get max+1, max+2, ... in ``order_cols`` order (max = 0 if all NULL).

    Distributed ``zipWithIndex``: the NULL-id rows are range-partitioned and
    sorted on ``order_cols``, each row's position inside its partition comes
    from ``monotonically_increasing_id`` and a per-partition offset table
    (one row per partition — bounded, so broadcast) turns it into a global
    sequence. No single-partition window. ``order_cols`` should be a total
    order; the id column is coerced to long (non-numeric -> NULL -> filled).
    """
    work = df.withColumn(id_col, F.coalesce(F.col(id_col).cast("string").try_cast("long"), F.col(id_col).cast("string").try_cast("double").try_cast("long")))
    mx = work.agg(F.max(id_col).alias("m")).first()["m"] or 0
    have = work.filter(F.col(id_col).isNotNull())
    miss = work.filter(F.col(id_col).isNull())
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = (miss.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
              .withColumn("__mid", F.monotonically_increasing_id()))
    ranked = ranked.withColumns({"__pid": F.shiftrightunsigned("__mid", 33),
                                 "__pos": F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))})
    # positions must be identical in the two branches below: cut lineage on
    # shared storage (reliable checkpoint, survives executor loss)
    ranked = cut_lineage(ranked)
    sizes = ranked.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.select("__pid", (F.sum("__n").over(Window.orderBy("__pid")) - F.col("__n")).alias("__off"))
    filled = (ranked.join(F.broadcast(offsets), on="__pid")
              .withColumn(id_col, (F.lit(mx) + F.col("__off") + F.col("__pos") + 1).cast("long"))
              .drop("__mid", "__pid", "__pos", "__off"))
    return have.unionByName(filled.select(*have.columns))
