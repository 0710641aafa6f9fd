"""Rule tests for the column functions (fidelity rules R1 ... R16, P-14 ... P-21)."""

from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from starmart.functions import (age_years, band, band_ge, clean, dround, flag_ge, one_hot,
                                ordinal, pct, pseudonymise, to_int, try_date, week_of_month,
                                weighted_score, year_diff)
from starmart.functions import features as feat
from starmart.functions.numeric import exact_avg, ravg
from starmart.functions.text import na_to_null


def one_col(spark, values, dtype, expr):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(expr(F.col("v")).alias("x")).collect()]


def test_r1_int_cast_rounds_half_to_even(spark):
    assert one_col(spark, [2.5, 3.5, 2.7, -2.5, 72.5, 73.5, None], "double", to_int) == \
        [2, 4, 3, -2, 72, 74, None]


def test_r2_year_difference_counts_calendar_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2000, 12, 31), dt.date(2001, 1, 1))], "a date, b date")
    assert df.select(year_diff("a", "b")).first()[0] == 1


def test_r3_percentage_is_double(spark):
    df = spark.createDataFrame([(1, 3)], "n long, t long")
    out = df.select(pct("n", "t").alias("p"))
    assert out.schema["p"].dataType.simpleString() == "double"
    assert out.first()[0] == 33.33


def test_r4_try_date(spark):
    values = ["2020-1-5", "2020/01/05", "2020", "2020-02-30", "2020-01-05Tx", "20-01-05",
              "2020-01-05 10:00:00", " 2020-01-05 ", "2020-01", "01/05/2020", None]
    expected = [dt.date(2020, 1, 5), dt.date(2020, 1, 5), None, None, None, dt.date(20, 1, 5),
                dt.date(2020, 1, 5), dt.date(2020, 1, 5), None, None, None]
    assert one_col(spark, values, "string", try_date) == expected


def test_r5_round_like_the_reference(spark):
    out = one_col(spark, [1.005, 0.285, 1.255, 2.5, -2.5], "double", lambda c: dround(c, 2))
    assert out == [1.0, 0.28, 1.25, 2.5, -2.5]
    assert one_col(spark, [2.5, -2.5], "double", lambda c: dround(c, 0)) == [3.0, -3.0]


def test_r7_trim_strips_unicode_spaces_keeps_tab(spark):
    values = [" Therapy ", "\tRest", " x ", "　y "]
    assert one_col(spark, values, "string", clean) == ["Therapy", "\tRest", "x", "y"]


def test_r8_sort_nulls_last_both_ways(spark):
    df = spark.createDataFrame([(None,), (1,), (2,)], "v int")
    assert [r[0] for r in df.orderBy(F.asc_nulls_last("v")).collect()] == [1, 2, None]
    assert [r[0] for r in df.orderBy(F.desc_nulls_last("v")).collect()] == [2, 1, None]


def test_r9_null_bmi_falls_to_else(spark):
    out = one_col(spark, [None, 18.5, 25.0, 30.0, 18.4], "double",
                  lambda c: band(c, feat.BMI_BANDS, feat.BMI_ELSE))
    assert out == ["Obese", "Normal", "Overweight", "Obese", "Underweight"]


def test_r10_flags_never_null(spark):
    assert one_col(spark, [None, 6.9, 7.0], "double", lambda c: flag_ge(c, 7.0)) == \
        [False, False, True]


def test_r11_stddev_of_one_row_is_null(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b", 3.0)], "g string, v double")
    got = dict(df.groupBy("g").agg(dround(F.stddev_samp("v"), 2)).collect())
    assert got == {"a": None, "b": 1.41}


def test_r12_md5_lower_hex_and_null(spark):
    out = one_col(spark, ["00123", None], "string", pseudonymise)
    assert out == [hashlib.md5(b"00123").hexdigest(), None]


def test_p17_weighted_score_edges(spark):
    parts = feat.ACTIVITY_SCORE_PARTS
    df = spark.createDataFrame(
        [(None, None, None), (0.0, 120.0, 3901.0), (14999.0, 120.0, 3901.0),
         (30000.0, 500.0, 9000.0), (0.0, 0.0, 1200.0)],
        "step_count double, exercise_duration double, calorie_expenditure double")
    got = [r[0] for r in df.select(weighted_score(parts)).collect()]
    # all NULL -> 0; step 0 -> its part is negative, total not clamped at part level
    assert got[0] == 0.0
    assert got[1] == 57.14
    assert got[2] == 100.0
    assert got[3] == 100.0
    assert got[4] == 0.0


def test_p20_trend_band_boundaries(spark):
    out = one_col(spark, [65.0, 64.99, 35.0, 34.99], "double",
                  lambda c: band_ge(c, feat.TREND_BANDS, feat.TREND_ELSE))
    assert out == ["improving", "stable", "stable", "declining"]


def test_p18_p19_unknown_category(spark):
    assert one_col(spark, ["poor", "good", "keto", None], "string",
                   lambda c: ordinal(c, feat.SLEEP_QUALITY_ORDER)) == [1, 3, None, None]
    df = spark.createDataFrame([("veg",), ("keto",), (None,)], "d string")
    got = [tuple(r) for r in df.select(*one_hot("d", feat.DIET_VALUES)).collect()]
    assert got == [(1, 0, 0), (0, 0, 0), (0, 0, 0)]


def test_p21_week_of_month(spark):
    dates = [dt.date(2024, 1, d) for d in (7, 8, 28, 29, 31)]
    assert one_col(spark, dates, "date", week_of_month) == [1, 2, 4, 5, 5]


def test_p13_age_from_birth_date_else_rounded_age(spark):
    df = spark.createDataFrame([(dt.date(2000, 12, 31), 30.0), (None, 20.5), (None, 21.5)],
                               "dob date, age double")
    got = [r[0] for r in df.select(age_years("dob", "age", "2001-01-01")).collect()]
    assert got == [1, 20, 22]


def test_r19_na_tokens(spark):
    values = ["", "NULL", "null", "None", "NaN", "NA", "n/a", "x"]
    assert one_col(spark, values, "string", na_to_null) == \
        [None, None, None, None, None, "NA", "n/a", "x"]


def test_exact_average_is_order_independent(spark):
    # 0.055 is a rounding tie: a float sum may land either side of it.
    vals = [0.05, 0.06] * 50 + [0.04, 0.07] * 25
    df = spark.createDataFrame([(v,) for v in vals], "v double").repartition(7)
    assert df.select(ravg("v", 2)).first()[0] == 0.06
    assert df.select(exact_avg("v")).first()[0] == pytest.approx(0.055)


def test_r13_greatest_least_skip_null(spark):
    import duckdb
    df = spark.createDataFrame([(None, 3.0), (5.0, None), (None, None)], "a double, b double")
    got = [tuple(r) for r in df.select(F.greatest("a", "b"), F.least("a", "b")).collect()]
    want = duckdb.sql("SELECT greatest(a, b), least(a, b) FROM (VALUES (NULL, 3.0), "
                      "(5.0, NULL), (NULL::DOUBLE, NULL::DOUBLE)) t(a, b)").fetchall()
    assert got == [(3.0, 3.0), (5.0, 5.0), (None, None)] == [tuple(r) for r in want]


def test_r15_nan_is_largest_in_bands_and_flags(spark):
    import duckdb
    nan = float("nan")
    bands = one_col(spark, [nan], "double", lambda c: band(c, feat.BMI_BANDS, feat.BMI_ELSE))
    flags = one_col(spark, [nan], "double", lambda c: flag_ge(c, 7.0))
    want = duckdb.sql("SELECT CASE WHEN v < 18.5 THEN 'Underweight' WHEN v < 25 THEN 'Normal' "
                      "WHEN v < 30 THEN 'Overweight' ELSE 'Obese' END, "
                      "CASE WHEN v >= 7.0 THEN TRUE ELSE FALSE END "
                      "FROM (SELECT 'NaN'::DOUBLE AS v)").fetchall()
    assert (bands[0], flags[0]) == ("Obese", True) == tuple(want[0])
