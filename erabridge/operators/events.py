"""Row-level steps on events: filter, flags, dimension columns, unnesting."""

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Event names as the tracker writes them.
SESSION_START = "session_start"
PAGE_VIEW = "page_view"
USER_ENGAGEMENT = "user_engagement"
PURCHASE = "purchase"

SESSION_REPORT_EVENTS = (SESSION_START, PAGE_VIEW, USER_ENGAGEMENT)
BOUNCE_EVENTS = (PAGE_VIEW, USER_ENGAGEMENT)
PRODUCT_EVENTS = (PURCHASE,)


def is_event(name: str) -> Column:
    return F.col("event_name") == F.lit(name)


def only_events(events: DataFrame, names: Iterable[str]) -> DataFrame:
    """Rows of the named events. The test reaches the scan as ``In``."""
    return events.where(F.col("event_name").isin(*names))


def events_of_days(events: DataFrame, first: date, last: date) -> DataFrame:
    """Rows of the days from ``first`` to ``last``.

    The stored day itself is compared, as text or number, so that folders and
    files of other days are skipped.
    """
    ends = [f"{day:%Y%m%d}" for day in (first, last)]
    if not isinstance(events.schema["event_date"].dataType, T.StringType):
        ends = [int(day) for day in ends]
    return events.where(F.col("event_date").between(*ends))


def with_event_flags(events: DataFrame) -> DataFrame:
    """Adds 0/1 columns for page views, session starts and purchases."""
    names = {
        "is_page_view": PAGE_VIEW,
        "is_session_start": SESSION_START,
        "is_purchase": PURCHASE,
    }
    return events.withColumns(
        {flag: F.when(is_event(n), 1).otherwise(0) for flag, n in names.items()}
    )


def unnest_items(events: DataFrame) -> DataFrame:
    """One row per purchased item; NULL and empty item lists give no row.

    The two item fields are zipped rather than exploding the item struct, so
    that of a wide item struct only these two are read from storage.
    """
    item = F.explode(F.arrays_zip("items.item_name", "items.quantity"))
    return events.select(
        "event_date",
        F.col("event_bundle_sequence_id").alias("session_id"),
        item.alias("item"),
    ).select(
        "event_date",
        "session_id",
        F.col("item.item_name").alias("product"),
        F.col("item.quantity").alias("quantity"),
    )
