"""Column expressions on tiny fixtures with the real column names (FIXTURES.md gotchas)."""

from pyspark.sql import functions as F

from roadframe import rules as R
from roadframe.functions import (
    any_in, clip, hour_from_hhmm, nonzero_flag, other_involved, pad_code, safe_date, single_in,
    strip_to_long, weekday_name,
)
from roadframe.functions.recode import collapse_target, recode_columns


def test_recode_passthrough_unknown_and_null(spark):
    # G1 null stays null, G2 unknown -> "-1", G3 unlisted code passes through, agg int64
    df = spark.createDataFrame([(None, 4, 1), (-1, 1, 2), (3, 99, None)], "lum int, catv int, agg int")
    out = recode_columns(df, R.RECODE_RULES).collect()
    assert out[0]["lum"] is None and out[0]["catv"] == "4" and out[0]["agg"] == 0
    assert out[1]["lum"] == "-1" and out[1]["catv"] == "cycle_edp" and out[1]["agg"] == 1
    assert out[2]["lum"] == "nocturne" and out[2]["catv"] == "pl" and out[2]["agg"] is None


def test_recode_float_codes_stay_recodable(spark):
    # 7.0 after a nullable join must still match code "7"
    df = spark.createDataFrame([(7.0,), (None,)], "catv double")
    assert [r[0] for r in recode_columns(df, R.RECODE_RULES).collect()] == ["vl", None]


def test_rules_are_one_pass_safe():
    assert R.validate_rules(R.RECODE_RULES) == []


def test_clip_keeps_null(spark):
    # G5
    df = spark.createDataFrame([(None,), (1800,), (2050,), (1990,)], "an_nais int")
    assert [r[0] for r in df.select(clip("an_nais", 1910, 2022)).collect()] == [None, 1910, 2022, 1990]


def test_strip_unicode_spaces(spark):
    # Plain and non-breaking spaces removed before the numeric coercion
    df = spark.createDataFrame([("138 306 524",), ("138 306 524",), ("12.0",), ("x",)], "id_vehicule string")
    assert [r[0] for r in df.select(strip_to_long("id_vehicule")).collect()] == [138306524, 138306524, 12, None]


def test_pad_code(spark):
    # G8
    df = spark.createDataFrame([("1",), ("01",), ("2A",), ("971",), ("999",)], "dep string")
    assert [r[0] for r in df.select(pad_code("dep")).collect()] == ["01", "01", "2A", "971", "999"]


def test_safe_date_and_weekday(spark):
    # Impossible dates -> NULL; fractional parts -> NULL
    df = spark.createDataFrame([(2020, 2.0, 31.0), (2020, 2.0, 29.0), (2020, 6.5, 1.0)], "an int, mois double, jour double")
    out = df.select(weekday_name(safe_date("an", "mois", "jour")).alias("w")).collect()
    assert [r.w for r in out] == [None, "Saturday", None]


def test_hour_and_tpc(spark):
    # G11 compat: null/decimal comma -> 1; G20: hhmm without colon keeps digits
    df = spark.createDataFrame([("14:30", None), ("1430", "0"), ("07:05", "-3"), (None, "5,5")],
                               "hrmn string, lartpc string")
    out = df.select(hour_from_hhmm("hrmn").alias("hr"), nonzero_flag("lartpc", 1).alias("tpc")).collect()
    assert [r.hr for r in out] == [14, 1430, 7, None]
    assert [r.tpc for r in out] == [1, 0, 1, 1]


def test_membership_flags(spark):
    # Secu 7 -> gants and airbag; all null -> 0; choc 9 -> all four
    df = spark.createDataFrame([(7, None, None, 9), (None, None, None, None)],
                               "secu1 int, secu2 int, secu3 int, choc int")
    row = df.select(any_in(["secu1", "secu2", "secu3"], [6, 7]).alias("g"),
                    any_in(["secu1", "secu2", "secu3"], [5, 7]).alias("a"),
                    *[single_in("choc", v).alias(k) for k, v in R.CHOC_FLAGS.items()]).collect()
    assert tuple(row[0]) == (1, 1, 1, 1, 1, 1)
    assert tuple(row[1]) == (0, 0, 0, 0, 0, 0)


def test_other_involved(spark):
    # Self counted out
    df = spark.createDataFrame([(1, 1), (0, 1), (1, 2), (0, 0)], "is_x int, count_x long")
    assert [r[0] for r in df.select(other_involved("is_x", "count_x")).collect()] == [0, 1, 1, 0]


def test_collapse_target(spark):
    # Grav 1,2,3,4,-1 -> 0,1,1,0, dropped
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (-1,), (None,)], "grav int")
    out = [r[0] for r in collapse_target(df, "grav", R.GRAV_COLLAPSE, -1, 1).collect()]
    assert out == [0, 1, 1, 0]


def test_safe_date_agrees_with_parsing(spark):
    parts = [(y, m, d) for y in (None, 0, 1, 1900, 1999, 2000, 9999, 10000, -4) for m in (None, 0, 1, 2, 4, 13) for d in (None, 0, 1, 28, 29, 30, 31, 32)]
    df = spark.createDataFrame(parts, "y int, m int, d int")
    parsed = F.try_to_date(F.concat_ws("-", *[F.col(c).cast("string") for c in "ymd"]), "y-M-d")
    out = df.select(safe_date("y", "m", "d").alias("made"), weekday_name(safe_date("y", "m", "d")).alias("name"), parsed.alias("parsed"))
    assert out.where(~F.col("made").eqNullSafe(F.col("parsed")) | ~F.col("name").eqNullSafe(F.date_format("parsed", "EEEE"))).count() == 0


def test_whole_numbers_are_not_stripped_as_text(spark):
    df = spark.createDataFrame([(5, " 5"), (None, None)], "v int, t string")
    plan = df.select(strip_to_long("v", df.schema["v"].dataType).alias("v"))
    assert "regexp" not in plan._jdf.queryExecution().optimizedPlan().toString()
    assert [r.v for r in plan.collect()] == [5, None] and plan.dtypes == [("v", "bigint")]
