"""Edge values of the cleansing helpers and of the exact arithmetic."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tiffin.functions.calc import divide, mean, mean_of_doubles, minute_boundaries, rounded
from tiffin.functions.clean import digits, to_double, to_flag, to_int, to_money, to_text, to_ts
from tiffin.sources.raw import null_tokens


def apply(rows, values, column):
    df = rows([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.v for r in df.select("i", column).orderBy("i").collect()]


@pytest.mark.parametrize(
    "value, number, money, whole",
    [
        (None, None, Decimal("0.00"), 0),
        ("", None, Decimal("0.00"), 0),
        ("  ", None, Decimal("0.00"), 0),
        (" 7 ", 7, Decimal("7.00"), 7),
        ("123.45", 123, Decimal("123.45"), 123),
        ("123.5", 124, Decimal("123.50"), 124),
        ("-2.5", -3, Decimal("-2.50"), -3),
        ("x", None, Decimal("0.00"), 0),
        ("1e3", 1000, Decimal("1000.00"), 1000),
        ("9223372036854775808", None, Decimal("9223372036854775808.00"), 9223372036854775808),
        ("9223372036854775807", 9223372036854775807, Decimal("9223372036854775807.00"), 9223372036854775807),
    ],
)
def test_numbers(rows, value, number, money, whole):
    assert apply(rows, [value], to_int("v")) == [number]
    assert apply(rows, [value], to_money("v")) == [money]
    if number is None or abs(number) < 10**17:
        assert apply(rows, [value], to_money("v", scale=0)) == [Decimal(whole)]


def test_number_defaults(rows):
    assert apply(rows, ["x", None, "4"], to_int("v", default=0)) == [0, 0, 4]
    assert apply(rows, ["x", None, "4"], to_money("v", default=None)) == [None, None, Decimal("4.00")]
    assert apply(rows, ["bad", None, "1.5"], to_double("v")) == [None, None, 1.5]
    assert apply(rows, ["bad", None, "1.5"], to_double("v", default=0.2)) == [0.2, 0.2, 1.5]


def test_timestamps(rows):
    got = apply(rows, ["2024-01-02 03:04:05", "2024-01-02", "soon", "", None], to_ts("v"))
    assert got == [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2), None, None, None]


def test_flags(rows):
    values = ["Y", "y", " TRUE ", "true", "1", "0", "N", "FALSE", "", None, "yes"]
    assert apply(rows, values, to_flag("v")) == [True] * 5 + [False] * 6


def test_text(rows):
    values = [" Ab ", "  ", "", None]
    assert apply(rows, values, to_text("v")) == ["Ab", "", "", None]
    assert apply(rows, values, to_text("v", blank_null=True)) == ["Ab", None, None, None]
    assert apply(rows, values, to_text("v", default="New")) == ["Ab", "New", "New", "New"]
    assert apply(rows, values, to_text("v", case="lower")) == ["ab", "", "", None]
    assert apply(rows, values, to_text("v", case="upper")) == ["AB", "", "", None]
    assert apply(rows, ["+91-98 7", "none", None], digits("v")) == ["91987", "", None]


def test_null_tokens_leave_other_types_alone(rows):
    df = rows([("", 1), ("NULL", 2), ("null", 3), ("Null", 4), (" ", 5), (None, 6)], "t string, n int")
    assert [tuple(r) for r in null_tokens(df).orderBy("n").collect()] == [
        (None, 1), (None, 2), (None, 3), ("Null", 4), (" ", 5), (None, 6),
    ]


def test_minute_boundaries(rows):
    pairs = [
        ("2024-01-01 10:00:50", "2024-01-01 10:02:10", 2),
        ("2024-01-01 10:00:59", "2024-01-01 10:01:00", 1),
        ("2023-12-31 23:59:59", "2024-01-01 00:00:00", 1),
        ("2024-01-02 00:00:00", "2024-01-01 23:59:00", -1),
        ("2024-01-01 10:00:00", None, None),
    ]
    df = rows(pairs, "a string, b string, want bigint").withColumns({c: F.col(c).cast("timestamp_ntz") for c in "ab"})
    assert all(r.got == r.want for r in df.select(minute_boundaries("a", "b").alias("got"), "want").collect())


def test_minutes_do_not_depend_on_the_session_zone(spark, rows):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:30 does not exist on that day
        df = rows([("2024-03-10 01:59:30", "2024-03-10 02:30:00")], "a string, b string")
        df = df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in "ab"})
        assert df.select(minute_boundaries("a", "b")).first()[0] == 31
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_averages_and_division(rows):
    df = rows([(1, 0.1), (2, 0.2), (None, None)], "n bigint, x double")
    got = df.agg(mean("n").alias("n"), mean_of_doubles("x").alias("x")).first()
    assert (got.n, got.x) == (1.5, 0.15)
    empty = df.filter("false").agg(mean("n").alias("n"), mean_of_doubles("x").alias("x")).first()
    assert tuple(empty) == (None, None)
    one = rows([(1, 0)], "a bigint, b bigint").select(divide(F.col("a"), F.col("b"))).first()[0]
    assert one is None


def test_rounding_is_half_up_in_decimal(rows):
    got = rows([(2.675,), (0.125,), (-0.125,)], "x double").select(rounded(F.col("x"), 2).alias("r")).collect()
    assert [r.r for r in got] == [2.68, 0.13, -0.13]


def test_money_keeps_every_digit_and_a_number_too_wide_is_no_default(rows):
    wide = "123456789012345678901234567890123456.78"
    assert apply(rows, [wide, "1e40", "none"], to_money("v")) == [Decimal(wide), None, Decimal("0.00")]


def test_averages_of_doubles_keep_small_digits_and_leave_out_what_is_not_finite(rows):
    def mean_of(*values):
        return rows([(v,) for v in values], "x double").agg(mean_of_doubles("x").alias("m")).first().m

    assert mean_of(0.123456789, 0.123456789) == 0.123456789
    assert mean_of(0.5, float("nan"), float("inf"), None) == 0.5
    assert mean_of(1e13, 3e13) == 2e13 and mean_of(1e300) == 1e300
    assert mean_of(float("nan")) is None and mean_of(None) is None
    got = rows([(2.67499999999,), (1e30,)], "x double").select(rounded(F.col("x"), 2).alias("r")).collect()
    assert [r.r for r in got] == [2.67, 1e30]
