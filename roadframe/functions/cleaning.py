"""Cleaning expressions: casts, clipping, coercion, dates, sentinels.

All conversions that can fail use ``try_*`` so they return NULL under ANSI
mode instead of failing the job (one bad row in 100 TB must not kill it).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DataType, DecimalType, DoubleType, FloatType, IntegerType,
    LongType, ShortType,
)

_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)
_FRACTIONAL = (FloatType, DoubleType, DecimalType)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canonical_code(c, dtype: DataType | None = None) -> Column:
    """Code column -> string without a float tail.

    Integral types print as integers; fractional values that are whole
    numbers print as integers too ("7.0" -> "7"), so codes that passed
    through a nullable join stay recodable. NULL stays NULL.
    """
    c = _col(c)
    if dtype is None or isinstance(dtype, _INTEGRAL):
        return c.cast("string")
    if isinstance(dtype, _FRACTIONAL):
        d = c.cast("double")
        return (F.when(d == F.floor(d), F.floor(d).cast("long").cast("string"))
                .otherwise(d.cast("string")))
    return c.cast("string")


def clip(c, lower=None, upper=None) -> Column:
    """Null-keeping clip (``greatest``/``least`` would turn NULL into a bound)."""
    c = _col(c)
    out = c
    if lower is not None and upper is not None:
        return F.when(c < F.lit(lower), F.lit(lower)).when(c > F.lit(upper), F.lit(upper)).otherwise(c)
    if lower is not None:
        out = F.when(c < F.lit(lower), F.lit(lower)).otherwise(c)
    if upper is not None:
        out = F.when(c > F.lit(upper), F.lit(upper)).otherwise(c)
    return out


def to_number(c) -> Column:
    """Text -> double, anything unparsable -> NULL (e.g. "5,5")."""
    return _col(c).cast("string").try_cast("double")


def strip_to_long(c, dtype: DataType | None = None) -> Column:
    """Remove every Unicode white space, then text -> long, bad -> NULL.

    ``(?U)`` makes ``\\s`` Unicode-aware so non-breaking spaces go too.
    Whole-number decimals ("12.0") are accepted like a numeric parser would.
    A column of an integral ``dtype`` holds no text to strip.
    """
    if isinstance(dtype, _INTEGRAL):
        return _col(c).cast("long")
    s = F.regexp_replace(_col(c).cast("string"), r"(?U)\s+", "")
    as_long = s.try_cast("long")
    as_double = s.try_cast("double")
    return F.coalesce(as_long,
                      F.when(as_double == F.floor(as_double), as_double.try_cast("long")))


def integral_or_null(c) -> Column:
    """Whole-number value as long, fractional or NULL -> NULL."""
    d = _col(c).cast("double")
    return F.when(d == F.floor(d), d.try_cast("long"))


def safe_date(year, month, day) -> Column:
    """(year, month, day) -> date; impossible or fractional parts -> NULL.

    Years of one to four digits go by arithmetic (parsing a text, and the exception behind
    every impossible date, cost several times the join of the row); others are parsed.
    """
    y, m, d = (integral_or_null(x) for x in (year, month, day))
    usual = y.between(1, 9999) & m.between(1, 12) & d.between(1, 31)
    first = F.make_date(y.cast("int"), m.cast("int"), F.lit(1))
    date = F.when((d <= 28) | (d <= F.day(F.last_day(first))), F.date_add(first, (d - 1).cast("int")))
    parsed = F.try_to_date(F.concat_ws("-", *[x.cast("string") for x in (y, m, d)]), "y-M-d")
    return F.when(usual, date).otherwise(F.when(~y.between(1, 9999), parsed))


_DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def weekday_name(d) -> Column:
    """English day name (Monday ... Sunday)."""
    d = _col(d)
    # element_at takes a NULL index for one when no element of the array is NULL
    return F.when(d.isNotNull(), F.element_at(F.array(*map(F.lit, _DAYS)), F.weekday(d) + 1))


def hour_from_hhmm(c) -> Column:
    """"HH:MM" -> HH as long; text without a colon keeps all digits."""
    return F.substring_index(_col(c).cast("string"), ":", 1).try_cast("long")


def nonzero_flag(c, null_as: int = 1) -> Column:
    """1 when |to_number(c)| != 0; unparsable/NULL -> ``null_as``."""
    x = to_number(c)
    return F.when(x.isNull(), F.lit(null_as)).when(F.abs(x) != 0, F.lit(1)).otherwise(F.lit(0)).cast("long")


def sentinel_to_null(c, sentinel) -> Column:
    """``nullif(c, sentinel)``."""
    c = _col(c)
    return F.when(c == F.lit(sentinel), F.lit(None)).otherwise(c)
