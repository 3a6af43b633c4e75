"""Daily sessions, page views and bounce rate from events.

A session is a (day, bundle sequence id, dimension value) with at least one
page view or engagement; it bounced if it has exactly one page view and no
engagement. NULL ids form one session per day and dimension value.
"""

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from erabridge.functions.dates import parse_event_date
from erabridge.operators.events import (
    BOUNCE_EVENTS,
    PAGE_VIEW,
    SESSION_REPORT_EVENTS,
    SESSION_START,
    USER_ENGAGEMENT,
    is_event,
    only_events,
)

# The dimension name under which ``session_reports`` keeps the whole day.
TOTAL = "total"
# The column of an event's kind, and the kinds.
KIND = "_kind"
START, VIEW, ENGAGEMENT = 0, 1, 2
# Stands for a missing day among days since 1970.
NO_DAY = -(1 << 30)

# ---------------------------------------------------------------- single steps


def dated(events: DataFrame, dim: str | None, path: str | None) -> DataFrame:
    """Date, session id, dimension and event name.

    The dimension is projected before anything groups by it: a dimension named
    like the struct it comes from would otherwise group by the whole struct.
    """
    dims = [F.col(path).alias(dim)] if dim else []
    return events.select(
        parse_event_date(F.col("event_date")).alias("date"),
        F.col("event_bundle_sequence_id").alias("session_id"),
        *dims,
        "event_name",
    )


def event_counts(
    events: DataFrame, name: str, total: str, dim: str | None, path: str | None
) -> DataFrame:
    """Rows of one event per day and dimension value."""
    rows = dated(only_events(events, [name]), dim, path)
    return rows.groupBy(*_keys(dim)).agg(F.count("*").alias(total))


def session_counts(
    events: DataFrame, dim: str | None = None, path: str | None = None
) -> DataFrame:
    return event_counts(events, SESSION_START, "sessions", dim, path)


def pageview_counts(
    events: DataFrame, dim: str | None = None, path: str | None = None
) -> DataFrame:
    return event_counts(events, PAGE_VIEW, "pageviews", dim, path)


def session_metrics(
    events: DataFrame, dim: str | None = None, path: str | None = None
) -> DataFrame:
    """Page views and engagements of each session."""
    rows = dated(only_events(events, BOUNCE_EVENTS), dim, path)
    return rows.groupBy("date", "session_id", *_keys(dim)[1:]).agg(
        F.count_if(is_event(PAGE_VIEW)).alias("views"),
        F.count_if(is_event(USER_ENGAGEMENT)).alias("engagements"),
    )


def bounce_rates(metrics: DataFrame, dim: str | None = None) -> DataFrame:
    """Share of bounced sessions per day and dimension value."""
    return metrics.groupBy(*_keys(dim)).agg(
        (F.count_if(_bounced()) / F.count("*")).alias("bounce_rate")
    )


def session_report_by_joins(
    events: DataFrame,
    dim: str | None = None,
    path: str | None = None,
    label: str = "source",
) -> DataFrame:
    """The report written as three aggregates and two left joins.

    Kept as the plain statement of the semantics, to test ``session_report``
    against; it reads the events three times.
    """
    keys = _keys(dim)
    sessions = session_counts(events, dim, path)
    views = pageview_counts(events, dim, path)
    bounces = bounce_rates(session_metrics(events, dim, path), dim)
    joined = sessions.join(views, keys, "left").join(bounces, keys, "left")
    return joined.select(
        *keys,
        "sessions",
        F.coalesce("pageviews", F.lit(0)).alias("pageviews"),
        (F.coalesce("bounce_rate", F.lit(0)) * F.lit(100)).alias("bounce_rate"),
        F.lit("GA4").alias(label),
    )


# ------------------------------------------------------------------- one pass


def session_report(
    events: DataFrame,
    dim: str | None = None,
    path: str | None = None,
    label: str = "source",
) -> DataFrame:
    """The report in one scan and two shuffles, without joins.

    Both shuffles follow a map-side aggregate, so a day, dimension value or
    session id holding much of the data reaches a reducer as one row per task.
    """
    rows = _kinds(dated(only_events(events, SESSION_REPORT_EVENTS), dim, path))
    daily = _daily_totals(_session_totals(rows, _keys(dim)), _keys(dim))
    return _finished(daily, _keys(dim)).withColumn(label, F.lit("GA4"))


def session_reports(events: DataFrame, dims: Mapping[str, str]) -> DataFrame:
    """The undimensioned report and one per entry of ``dims``, in one scan.

    ``dims`` maps dimension names to event fields. The result has one row per
    (``dimension``, ``value``, ``date``); the undimensioned report is found
    under the dimension ``total``. Each event is unpivoted into one row per
    report, and the map-side aggregate folds these before they are shuffled.
    """
    names = [TOTAL, *dims]
    rows = only_events(events, SESSION_REPORT_EVENTS).select(
        parse_event_date(F.col("event_date")).alias("date"),
        F.col("event_bundle_sequence_id").alias("session_id"),
        "event_name",
        F.lit(None).cast("string").alias("0"),
        *[F.col(path).alias(str(i)) for i, path in enumerate(dims.values(), 1)],
    )
    day = F.coalesce(F.unix_date("date"), F.lit(NO_DAY)).cast("bigint")
    numbers = [str(i) for i in range(len(names))]
    long = (
        _kinds(rows)
        .withColumn("date", day)
        .unpivot(["date", "session_id", KIND], numbers, "dimension", "value")
    )
    daily = _daily_totals_of_slots(_slot_totals(long, len(names)), len(names))
    # Without a dimension there is no value to be missing.
    no_value = (F.col("dimension") != 0) & F.col("value").isNull()
    keys = ["date", "dimension", "value"]
    found = _finished(daily, keys, F.col("date").isNull() | no_value)
    name = F.get(F.array(*map(F.lit, names)), F.col("dimension").cast("int"))
    return found.withColumn("dimension", name)


def _slot_totals(long: DataFrame, dims: int) -> DataFrame:
    """Events per session, or session starts per day, of each (slot, value).

    There are four groups per session, so a group is made small: a slot is the day and
    the dimension in one number, of which starts have their own, and starts and page
    views share a column.
    """
    dimension = F.col("dimension").cast("bigint")
    kind = F.when(F.col(KIND) == START, dimension + dims).otherwise(dimension)
    slot = (F.col("date") * (2 * dims) + kind).alias("slot")
    return (
        long.select("session_id", slot, "value", KIND)
        .groupBy("session_id", "slot", "value")
        .agg(
            F.count_if(F.col(KIND) != ENGAGEMENT).alias("views"),
            F.count_if(F.col(KIND) == ENGAGEMENT).alias("engagements"),
        )
    )


def _daily_totals_of_slots(sessions: DataFrame, dims: int) -> DataFrame:
    kind = F.pmod("slot", F.lit(2 * dims))
    day = F.expr(f"(slot - pmod(slot, {2 * dims})) div {2 * dims}").cast("int")
    date = F.when(day != NO_DAY, F.date_from_unix_date(day))
    views, engagements = F.col("views"), F.col("engagements")
    started, active = kind >= dims, (views > 0) | (engagements > 0)
    return sessions.select(
        date.alias("date"),
        F.pmod(kind, F.lit(dims)).alias("dimension"),
        "value",
        F.when(started, views).otherwise(0).alias("starts"),
        F.when(started, F.lit(0)).otherwise(views).alias("views"),
        (~started & active & _bounced()).alias("bounced"),
        (~started & active).alias("active"),
    ).groupBy("date", "dimension", "value").agg(
        F.sum("starts").alias("sessions"),
        F.sum("views").alias("pageviews"),
        F.count_if("bounced").alias("bounced"),
        F.count_if("active").alias("active"),
    )


def _keys(dim: str | None) -> list[str]:
    return ["date", dim] if dim else ["date"]


def _bounced() -> Column:
    return (F.col("views") == 1) & (F.col("engagements") == 0)


def _kinds(rows: DataFrame) -> DataFrame:
    """``rows`` with a number for the event's name, which is compared once a row.

    Session starts are only ever counted per day and value, so they give up
    their session id. That leaves them one row per task instead of one per
    session, and adds no views or engagements to the session without an id.
    """
    kind = (
        F.when(is_event(SESSION_START), F.lit(START))
        .when(is_event(PAGE_VIEW), F.lit(VIEW))
        .when(is_event(USER_ENGAGEMENT), F.lit(ENGAGEMENT))
    )
    rows = rows.withColumn(KIND, kind.cast("tinyint")).drop("event_name")
    session = F.when(F.col(KIND) != START, F.col("session_id"))
    return rows.withColumn("session_id", session)


def _session_totals(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Events of each kind per session."""
    return rows.groupBy("session_id", *keys).agg(
        F.count_if(F.col(KIND) == START).alias("starts"),
        F.count_if(F.col(KIND) == VIEW).alias("views"),
        F.count_if(F.col(KIND) == ENGAGEMENT).alias("engagements"),
    )


def _daily_totals(sessions: DataFrame, keys: list[str]) -> DataFrame:
    active = (F.col("views") > 0) | (F.col("engagements") > 0)
    return sessions.groupBy(*keys).agg(
        F.sum("starts").alias("sessions"),
        F.sum("views").alias("pageviews"),
        F.count_if(_bounced()).alias("bounced"),
        F.count_if(active).alias("active"),
    )


def _finished(
    daily: DataFrame, keys: list[str], keyless: Column | None = None
) -> DataFrame:
    """Report columns from daily totals.

    Days and values without a session start are left out. Page views and bounce
    rate belong to a row by equality of its keys, which NULL never fulfils, so
    a row with a NULL key shows 0 for both.
    """
    if keyless is None:
        keyless = reduce(or_, [F.col(key).isNull() for key in keys])
    rate = F.when(
        ~keyless & (F.col("active") > 0), F.col("bounced") / F.col("active")
    )
    return daily.where(F.col("sessions") > 0).select(
        *keys,
        "sessions",
        F.when(keyless, F.lit(0)).otherwise(F.col("pageviews")).alias("pageviews"),
        (F.coalesce(rate, F.lit(0.0)) * F.lit(100)).alias("bounce_rate"),
    )
