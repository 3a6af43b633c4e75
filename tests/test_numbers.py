from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from erabridge.functions.numbers import (
    NUMBER_LIKE,
    clean_double,
    clean_int,
    parse_bounce,
    strip_separator,
)

TEXT = T.StringType()


def one(spark, value, rule, dtype=TEXT):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("v", dtype)]))
    return df.select(rule(F.col("v"))).first()[0]


@pytest.fixture(params=["true", "false"])
def either_ansi(spark, request):
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.unset("spark.sql.ansi.enabled")


def share(column, dtype=TEXT):
    return parse_bounce(column, times=1, dtype=dtype)


@pytest.mark.parametrize(
    "text, value",
    [
        ("0.45", 0.45),
        ("0,4567", 0.4567),
        ("<0.01%", 0.0001),
        ("5.", 5.0),
        (".5", 0.5),
        ("12", 12.0),
        (None, 0.0),
        ("", 0.0),
        ("(not set)", 0.0),
        ("-0.5", 0.0),
        ("1e-05", 0.0),
        ("12 5", 0.0),
        ("1\u202f234", 0.0),
        ("0.45\n", 0.0),
        ("NaN", 0.0),
    ],
)
def test_bounce_text(spark, either_ansi, text, value):
    assert one(spark, text, share) == value


@pytest.mark.parametrize(
    "text",
    ["45%", "45,3%", "<0,01%", "1,234.5", ".", ",", "<", "<0.01%%", "1<0.01%2.3"],
)
def test_bad_bounce_text_raises(spark, either_ansi, text):
    with pytest.raises(Exception, match="not a valid "):
        one(spark, text, share)


def test_bounce_scales_are_exact(spark):
    def scaled(times, over):
        return one(spark, "0,4567", lambda c: parse_bounce(c, times, over))

    assert scaled(100, 1) == 0.4567 * 100
    assert scaled(10, 1) == 0.4567 * 10
    assert scaled(1, 100) == 0.4567 / 100


@pytest.mark.parametrize(
    "value, expected",
    [
        (0.0005, 0.0005),
        (12.0, 12.0),
        (0.0, 0.0),
        (-0.5, 0.0),
        (None, 0.0),
        (float("nan"), 0.0),
        (float("inf"), 0.0),
    ],
)
def test_numeric_bounce(spark, value, expected):
    rule = lambda c: share(c, T.DoubleType())
    assert one(spark, value, rule, T.DoubleType()) == expected


@pytest.mark.parametrize(
    "text, value",
    [
        ("0", 0),
        ("999", 999),
        ("1\u202f234", 1234),
        ("1\u202f234\u202f567", 1234567),
        (" 12 ", 12),
        (None, None),
    ],
)
def test_count_text(spark, either_ansi, text, value):
    assert one(spark, text, clean_int) == value


@pytest.mark.parametrize(
    "text", ["1\u00a0234", "1 234", "1,234", "12.0", "", "n/a", "99999999999999999999"]
)
def test_bad_count_text_raises(spark, either_ansi, text):
    with pytest.raises(Exception, match="not a valid "):
        one(spark, text, clean_int)


def test_typed_counts(spark):
    assert one(spark, 7, lambda c: clean_int(c, T.LongType()), T.LongType()) == 7
    double = lambda c: clean_int(c, T.DoubleType())
    assert one(spark, 12.0, double, T.DoubleType()) == 12
    assert one(spark, None, double, T.DoubleType()) is None
    money = T.DecimalType(10, 2)
    decimal = lambda c: clean_int(c, money)
    assert one(spark, Decimal("12.00"), decimal, money) == 12
    for bad in (12.5, float("nan"), float("inf"), 1e30):
        with pytest.raises(Exception, match="not a valid "):
            one(spark, bad, double, T.DoubleType())


@pytest.mark.parametrize(
    "text, value",
    [
        ("3\u202f456", 3456.0),
        ("12.0", 12.0),
        ("-1.5", -1.5),
        ("1e3", 1000.0),
        (None, None),
    ],
)
def test_amount_text(spark, either_ansi, text, value):
    assert one(spark, text, clean_double) == value


@pytest.mark.parametrize("text", ["1,5", "1\u00a0234", "", "12f", "12d", "5.D ", "abc"])
def test_bad_amount_text_raises(spark, either_ansi, text):
    with pytest.raises(Exception, match="not a valid "):
        one(spark, text, clean_double)


def test_typed_amounts(spark):
    money = T.DecimalType(10, 2)
    assert one(spark, Decimal("1.25"), lambda c: clean_double(c, money), money) == 1.25
    assert one(spark, 3, lambda c: clean_double(c, T.LongType()), T.LongType()) == 3.0


def test_only_the_narrow_space_is_stripped(spark):
    assert one(spark, "1\u202f2\u00a03 4", strip_separator) == "12\u00a03 4"


def test_guard_does_not_pass_a_final_newline(spark):
    rule = lambda c: c.rlike(NUMBER_LIKE)
    assert one(spark, "0.45", rule) is True
    assert one(spark, "0.45\n", rule) is False
    assert one(spark, None, rule) is None
