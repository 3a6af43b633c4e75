from datetime import date

import pytest

from erabridge.operators.history import clean_product_history, clean_session_history
from helpers import as_set

D1 = date(2020, 5, 1)


def test_text_history(spark):
    history = spark.createDataFrame(
        [
            ("2020-05-01", "a", "1\u202f234", "2", "0,5"),
            ("2020-05-01", None, None, "0", "(not set)"),
        ],
        "date string, campaign string, sessions string, pageviews string,"
        " bounce_rate string",
    )
    cleaned = clean_session_history(history, "campaign", label="source_type")
    assert cleaned.columns == [
        "date", "campaign", "sessions", "pageviews", "bounce_rate", "source_type"
    ]
    assert as_set(cleaned) == {
        (D1, "a", 1234, 2, 50.0, "UA"),
        (D1, None, None, 0, 0.0, "UA"),
    }


def test_typed_history_gives_the_same_rows(spark):
    history = spark.createDataFrame(
        [(D1, 12.0, 5, 0.0005), (D1, 3.0, 4, -1.0)],
        "date date, sessions double, pageviews int, bounce_rate double",
    )
    cleaned = clean_session_history(history, times=1, over=100)
    assert as_set(cleaned) == {
        (D1, 12, 5, 0.0005 / 100, "UA"),
        (D1, 3, 4, 0.0, "UA"),
    }
    assert dict(cleaned.dtypes)["sessions"] == "bigint"


def test_product_history(spark):
    history = spark.createDataFrame(
        [("2020-05-01", "mug", "1\u202f000", "2.5")],
        "date string, product string, unique_purchases string, product_revenue string",
    )
    assert as_set(clean_product_history(history)) == {(D1, "mug", 1000.0, 2.5, "UA")}


@pytest.mark.parametrize(
    "row",
    [
        ("2020-05-01", "x", "1", "0.5"),
        ("2020-05-01", "1", "1", "45%"),
        ("01/05/2020", "1", "1", "0.5"),
    ],
)
def test_bad_history_fails_the_job(spark, row):
    history = spark.createDataFrame(
        [row], "date string, sessions string, pageviews string, bounce_rate string"
    )
    with pytest.raises(Exception, match="not a valid "):
        clean_session_history(history).collect()
