"""Rule compiler: JSON-style recode rules -> one projection of CASE expressions.

A rule is ``{"dtype": "category"|"int64", "modalities": {label: [codes]},
"to_nan": [codes]}``. Listed codes become their label, ``to_nan`` codes become
the sentinel ``"-1"``, every other value passes through unchanged and NULL
stays NULL. All columns are recoded in a single ``select`` (one pass, one
codegen stage) instead of one replace per label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadframe.functions.cleaning import canonical_code
from roadframe.rules import validate_rules

UNKNOWN = "-1"


def recode(c, spec: dict, dtype=None, unknown: str | None = UNKNOWN) -> Column:
    """Compile one rule into a CASE expression over the canonical code text."""
    s = canonical_code(F.col(c) if isinstance(c, str) else c, dtype)
    expr = None
    for label, codes in spec.get("modalities", {}).items():
        cond = s.isin([str(v) for v in codes])
        expr = F.when(cond, F.lit(str(label))) if expr is None else expr.when(cond, F.lit(str(label)))
    to_nan = [str(v) for v in spec.get("to_nan", [])]
    if to_nan:
        target = F.lit(unknown) if unknown is not None else F.lit(None).cast("string")
        expr = F.when(s.isin(to_nan), target) if expr is None else expr.when(s.isin(to_nan), target)
    out = s if expr is None else expr.otherwise(s)
    if spec.get("dtype") == "int64":
        out = out.try_cast("long")
    return out


def recode_columns(df: DataFrame, rules: dict[str, dict], unknown: str | None = UNKNOWN) -> DataFrame:
    """Apply every rule whose column exists; other columns are untouched."""
    bad = validate_rules(rules)
    if bad:
        raise ValueError(f"rules are order-dependent, cannot compile in one pass: {bad}")
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs = []
    for name in df.columns:
        if name in rules:
            exprs.append(recode(name, rules[name], types[name], unknown).alias(name))
        else:
            exprs.append(F.col(f"`{name}`"))
    return df.select(*exprs)


RULE_ROWS = "column string, position int, code string, label string, unknown boolean"


def rule_table(spark: SparkSession, rules: dict[str, dict]) -> DataFrame:
    """Rules as rows: one for each code, with its label and the label's place in the rule (unknown codes come last)."""
    rows = []
    for column, spec in rules.items():
        labels = list(spec.get("modalities", {}).items())
        rows += [(column, i, str(c), str(label), False) for i, (label, codes) in enumerate(labels) for c in codes]
        rows += [(column, len(labels), str(c), UNKNOWN, True) for c in spec.get("to_nan", [])]
    return spark.createDataFrame(rows, RULE_ROWS)


def order_dependent(table: DataFrame) -> DataFrame:
    """(column, label, later): labels that are codes of a later label, for which one pass is not a replacement label by label."""
    known = table.where(~F.col("unknown"))
    produced = known.select("column", "label", "position").distinct()
    codes = known.select(F.col("column").alias("__c"), F.col("code"), F.col("label").alias("later"), F.col("position").alias("__p"))
    return produced.join(codes, (F.col("column") == F.col("__c")) & (F.col("label") == F.col("code")) & (F.col("__p") > F.col("position"))) \
        .select("column", "label", "later").distinct()


def recode_by_table(df: DataFrame, table: DataFrame, columns: list[str], integers: list[str] | None = None) -> DataFrame:
    """``recode_columns`` for rule sets too large for expressions: one lookup join a column, whose size Spark weighs.

    ``table`` has ``RULE_ROWS``; a code that is listed twice gets its first label; ``integers`` become longs.
    """
    bad = order_dependent(table.where(F.col("column").isin(columns))).limit(10).collect()
    if bad:
        raise ValueError(f"rules are order-dependent, cannot compile in one pass: {[tuple(r) for r in bad]}")
    order, types = df.columns, {f.name: f.dataType for f in df.schema.fields}
    for i, c in enumerate(columns):
        if c not in types:
            continue
        lookup = table.where(F.col("column") == c).groupBy(F.col("code").alias(f"__code_{i}")).agg(F.min_by("label", "position").alias(f"__label_{i}"))
        text = canonical_code(F.col(f"`{c}`"), types[c])
        value = F.coalesce(F.col(f"__label_{i}"), text)
        df = df.join(lookup, text == F.col(f"__code_{i}"), "left") \
            .select([(value.try_cast("long") if c in (integers or []) else value).alias(n) if n == c else F.col(f"`{n}`") for n in order])
    return df


def collapse_target(df: DataFrame, col: str = "grav", collapse: dict | None = None,
                    drop_value=-1, shift: int = 1) -> DataFrame:
    """Merge classes (e.g. 4 -> 1, 3 -> 2), drop a class, shift to start at 0.

    Rows whose target is NULL are dropped as well (they cannot be labelled).
    """
    collapse = collapse or {}
    c = F.col(col).cast("long")
    mapped = c
    if collapse:
        expr = None
        for old, new in collapse.items():
            expr = F.when(c == F.lit(old), F.lit(new)) if expr is None else expr.when(c == F.lit(old), F.lit(new))
        mapped = expr.otherwise(c)
    return (df.withColumn(col, mapped.cast("long"))
              .filter(F.col(col).isNotNull() & (F.col(col) != F.lit(drop_value)))
              .withColumn(col, F.col(col) - F.lit(shift)))
