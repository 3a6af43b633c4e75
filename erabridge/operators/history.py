"""Cleaning of the exported history. Narrow throughout: no shuffle."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from erabridge.functions.dates import history_date
from erabridge.functions.numbers import clean_double, clean_int, parse_bounce


def clean_session_history(
    history: DataFrame,
    dim: str | None = None,
    times: int = 100,
    over: int = 1,
    label: str = "source",
) -> DataFrame:
    """Sessions, page views and scaled bounce rate, one row per input row."""
    dims = [F.col(dim).cast("string").alias(dim)] if dim else []
    return history.select(
        _cleaned(history, "date", history_date),
        *dims,
        _cleaned(history, "sessions", clean_int),
        _cleaned(history, "pageviews", clean_int),
        parse_bounce(
            F.col("bounce_rate"), times, over, history.schema["bounce_rate"].dataType
        ).alias("bounce_rate"),
        F.lit("UA").alias(label),
    )


def clean_product_history(
    history: DataFrame, label: str = "source_type"
) -> DataFrame:
    """Unique purchases and product revenue, one row per input row."""
    return history.select(
        _cleaned(history, "date", history_date),
        F.col("product").cast("string").alias("product"),
        _cleaned(history, "unique_purchases", clean_double),
        _cleaned(history, "product_revenue", clean_double),
        F.lit("UA").alias(label),
    )


def _cleaned(history: DataFrame, name: str, rule) -> Column:
    return rule(F.col(name), history.schema[name].dataType).alias(name)
