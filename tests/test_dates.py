from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from erabridge.functions.dates import history_date, parse_event_date


def one(spark, value, dtype, rule):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("v", dtype)]))
    return df.select(rule(F.col("v"))).first()[0]


@pytest.fixture(params=["true", "false"])
def either_ansi(spark, request):
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize(
    "text, day",
    [
        ("20240101", date(2024, 1, 1)),
        ("20240229", date(2024, 2, 29)),
        ("20231231", date(2023, 12, 31)),
        (None, None),
    ],
)
def test_event_day(spark, either_ansi, text, day):
    assert one(spark, text, T.StringType(), parse_event_date) == day


@pytest.mark.parametrize(
    "text",
    [
        "20240230",
        "20230229",
        "2024-02-29",
        "2024229",
        " 2024101",
        "2024101 ",
        "+2024011",
        "-2024011",
        "+020240101",
        "202401011",
        "2024.101",
        "20241301",
        "20240100",
        "",
        "today",
    ],
)
def test_bad_event_day_raises(spark, either_ansi, text):
    with pytest.raises(Exception, match="not a valid yyyyMMdd day|Invalid (value|date)"):
        one(spark, text, T.StringType(), parse_event_date)


def test_event_day_as_number(spark):
    assert one(spark, 20240229, T.LongType(), parse_event_date) == date(2024, 2, 29)


def test_every_day_of_many_years(spark):
    days = spark.sql(
        "select explode(sequence(date'1995-01-01', date'2040-12-31')) as day"
    )
    text = F.date_format("day", "yyyyMMdd")
    wrong = days.where(~F.col("day").eqNullSafe(parse_event_date(text)))
    assert days.count() > 16000 and wrong.count() == 0


@pytest.mark.parametrize("text", ["2024-01-05", "2024-1-5", " 2024-01-05 "])
def test_history_day(spark, either_ansi, text):
    assert one(spark, text, T.StringType(), history_date) == date(2024, 1, 5)


@pytest.mark.parametrize(
    "text",
    [
        "2023",
        "2023-01",
        "2023-01-05T10:00:00",
        "2023-01-05 10:00:00",
        "20230105",
        "05/01/2023",
        "2023-02-30",
        "2023-01-05\nx",
        "",
    ],
)
def test_bad_history_day_raises(spark, either_ansi, text):
    with pytest.raises(Exception, match="not a valid yyyy-mm-dd day"):
        one(spark, text, T.StringType(), history_date)


def test_history_day_null_and_typed(spark):
    assert one(spark, None, T.StringType(), history_date) is None
    day = date(2024, 1, 5)
    typed = lambda c: history_date(c, T.DateType())
    assert one(spark, day, T.DateType(), typed) == day


@pytest.mark.parametrize("text", ["09991231", "00010101", "99991231"])
def test_days_of_all_years(spark, text):
    df = spark.createDataFrame([(text,)], "day string")
    found = df.select(parse_event_date(F.col("day")).cast("string").alias("d")).first().d
    assert found.replace("-", "") == text


@pytest.mark.parametrize("text", ["00000101", "-0010101", "+2024010", " 2024010", "2024010 "])
def test_eight_signs_that_are_no_day_raise(spark, text):
    df = spark.createDataFrame([(text,)], "day string")
    with pytest.raises(Exception, match="not a valid yyyyMMdd day"):
        df.select(parse_event_date(F.col("day"))).collect()


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Asia/Tokyo", "UTC"])
def test_an_instant_belongs_to_its_day_in_utc(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        seconds = [1704420000, 1704412799, 1704412800, -1, 0]
        df = spark.createDataFrame([(s,) for s in seconds], "s long")
        instant = history_date(F.timestamp_seconds("s"), T.TimestampType())
        found = [r.d for r in df.select(instant.cast("string").alias("d")).collect()]
        assert found == ["2024-01-05", "2024-01-04", "2024-01-05", "1969-12-31", "1970-01-01"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
