import math
from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from monthglass.functions import dates, numeric, text


def values(spark, column, rows, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_safe_double(spark):
    got = values(spark, text.safe_double(F.col("x")), ["25_", "1-2", "5d", "NaN", " 7 ", "", None, "1e3", "-.5", "1e999", "+3."])
    assert got == [None, None, None, None, 7.0, None, None, 1000.0, -0.5, None, 3.0]


def test_strip_non_numeric(spark):
    got = values(spark, text.strip_non_numeric(F.col("x")), ["1000_", "1-2", "$1,234.5", "abc", None, "-7"])
    assert got == [1000.0, None, 1234.5, None, None, -7.0]


def test_durations(spark):
    rows = ["5 Years and 3 Months", "1 Year", "7 months", "foo", None, "2 YEARS and 1 MONTH", ""]
    assert values(spark, text.parse_duration_months(F.col("x")), rows) == [63, 12, 7, 0, None, 25, 0]


def test_strip_removes_tabs_and_wide_blanks(spark):
    assert values(spark, text.strip_whitespace(F.col("x")), ["\t a b \n", " x", None]) == ["a b", "x", None]


def test_placeholders_are_exact(spark):
    got = values(spark, text.null_if_in(F.col("x"), text.FINANCIAL_NULLS), ["_", " NA ", "NA", " ", "ok", None])
    assert got == [None, " NA ", None, None, "ok", None]


def test_pattern_is_anchored_at_the_start_only(spark):
    got = values(spark, text.matches_from_start(F.col("x"), r"\d{3}|z"), ["123x", "x123", "z", None])
    assert got == [True, False, True, None]


def test_finite(spark):
    assert values(spark, text.finite(F.col("x")), [1.0, float("nan"), float("inf"), -math.inf, None], "double") == [
        1.0, None, None, None, None,
    ]


def test_clip_keeps_null(spark):
    assert values(spark, numeric.clip(F.col("x"), 1.0, 2.0), [0.0, 1.5, 3.0, None], "double") == [1.0, 1.5, 2.0, None]


def test_age_classes_are_right_closed(spark):
    column = numeric.bin_right_closed(F.col("x"), numeric.AGE_EDGES, numeric.AGE_LABELS)
    got = values(spark, column, [0.0, 18.0, 25.0, 25.5, 35.0, 55.0, 75.1, 100.0, 101.0, None], "double")
    assert got == [None, "18-25", "18-25", "26-35", "26-35", "46-55", "56+", "56+", None, None]


def test_ratio_and_log(spark):
    df = spark.createDataFrame([(1.0, -1.0), (4.0, 1.0), (None, 1.0)], "a double, b double")
    got = df.select(numeric.safe_ratio(F.col("a"), F.col("b")), numeric.log1p_filled(F.col("b"))).collect()
    assert [r[0] for r in got] == [None, 2.0, None]
    assert got[0][1] is None and got[1][1] == pytest.approx(math.log(2))


def test_histogram_bin(spark):
    edges = [0.0, 1.0, 2.0]
    got = values(spark, numeric.histogram_bin(F.col("x"), edges), [-0.1, 0.0, 1.0, 2.0, 2.1, None], "double")
    assert got == [None, 0, 1, 1, None, None]


def test_months(spark):
    df = spark.createDataFrame([(dt(2023, 8, 31, 5), dt(2022, 11, 1))], "a timestamp, b timestamp")
    row = df.select(
        dates.plus_months(F.col("a"), 6).alias("later"),
        dates.months_between_calendar(F.col("a"), F.col("b")).alias("m"),
        dates.month_label(F.col("a")).alias("label"),
        dates.month_label(F.lit(None).cast("timestamp")).alias("none"),
        dates.elapsed_days(F.col("a"), F.lit("2023-08-30 12:00:00").cast("timestamp")).alias("d"),
    ).first()
    assert (row.later, row.m, row.label, row.none, row.d) == (dt(2024, 2, 29, 5), 9, "2023-08", "NaT", 0)


def test_numbers_with_exponents_are_kept(spark):
    got = values(spark, text.strip_non_numeric(F.col("x")), ["1e-05", "1.5e3", "25_", "5d", "1-2"])
    assert got == [1e-05, 1500.0, 25.0, 5.0, None]


def test_dates_in_several_formats(spark):
    from monthglass.functions.dates import parse_date

    texts = ["2023-01-02", "2023-01-02 03:04:05", "01/02/2023", "1/2/2023", "2023/01/02", "20230102", "02-Jan-2023", "2 Jan 2023", "Jan 2, 2023", "January 2, 2023", " 2023-01-02 "]
    got = values(spark, parse_date(F.col("x")), [*texts, "02.01.2023", "x", "", None])
    assert {d.date().isoformat() for d in got[: len(texts)]} == {"2023-01-02"} and got[len(texts) :] == [None] * 4
