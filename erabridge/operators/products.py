"""Daily product figures from purchase events."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from erabridge.functions.dates import parse_event_date
from erabridge.operators.events import PRODUCT_EVENTS, only_events, unnest_items


def purchased_items(events: DataFrame) -> DataFrame:
    """One dated row per item of a purchase."""
    items = unnest_items(only_events(events, PRODUCT_EVENTS))
    return items.select(
        parse_event_date(F.col("event_date")).alias("date"),
        "session_id",
        "product",
        "quantity",
    )


def product_report(events: DataFrame, label: str = "source_type") -> DataFrame:
    """Unique purchases and items sold per day and product.

    ``product_revenue`` is the number of items, as the report defines it. The
    exact distinct count runs as two shuffles, first on (date, product,
    session), so a best-selling product is spread over many tasks.
    """
    return (
        purchased_items(events)
        .groupBy("date", "product")
        .agg(
            F.count_distinct("session_id").alias("unique_purchases"),
            F.sum("quantity").alias("product_revenue"),
        )
        .withColumn(label, F.lit("GA4"))
    )
