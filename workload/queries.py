"""Every operator and report as a query on the test tables."""

import tempfile
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from erabridge.functions.dates import history_date, parse_event_date
from erabridge.functions.numbers import (
    NUMBER_LIKE,
    clean_double,
    clean_int,
    parse_bounce,
    strip_separator,
)
from erabridge.operators import sessions as S
from erabridge.operators.events import (
    PAGE_VIEW,
    PRODUCT_EVENTS,
    SESSION_REPORT_EVENTS,
    USER_ENGAGEMENT,
    is_event,
    only_events,
    unnest_items,
    with_event_flags,
)
from erabridge.operators.products import purchased_items
from erabridge.plans.reports import (
    REPORTS,
    build_report,
    ga4_half,
    refresh_all,
    ua_half,
    write_report,
)
from erabridge.sources.shared import shared_folder
from workload.adapters import event_rows, history_rows

Query = Callable[[SparkSession, str], DataFrame]

CAMPAIGN = ("campaign", "traffic_source.name")


def _names(spec) -> tuple[str, ...]:
    return PRODUCT_EVENTS if spec.products else SESSION_REPORT_EVENTS


# --------------------------------------------------------------------- reports


def report(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = REPORTS[name]
    return build_report(
        spec, event_rows(spark, sf_dir, _names(spec)), history_rows(spark, sf_dir)
    )


def recent_half(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return ga4_half(REPORTS[name], event_rows(spark, sf_dir))


def history_half(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return ua_half(REPORTS[name], history_rows(spark, sf_dir))


def all_session_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.session_reports(
        event_rows(spark, sf_dir, SESSION_REPORT_EVENTS),
        {
            "campaign": "traffic_source.name",
            "device": "device.category",
            "source": "traffic_source.source",
        },
    )


# ------------------------------------------------------------ scans and tables


def scan_ga4_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_rows(spark, sf_dir).select(
        "event_date",
        "event_name",
        F.col("event_bundle_sequence_id").alias("session_id"),
        F.col("traffic_source.name").alias("campaign"),
        F.col("traffic_source.source").alias("source"),
        F.col("device.category").alias("device"),
        F.coalesce(F.size("items"), F.lit(-1)).cast("bigint").alias("item_count"),
    )


def scan_ua_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_rows(spark, sf_dir)


def _folder(spark: SparkSession) -> str:
    """The session's shared folder; where a local session names none, one in /tmp."""
    try:
        return shared_folder(spark)
    except ValueError:
        if not spark.sparkContext.master.startswith("local"):
            raise
        return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def sink_replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice, first without the history: the second replaces the first."""
    spec = REPORTS["traffic"]
    table, folder = f"traffic_ua_ga4_{uuid.uuid4().hex[:12]}", _folder(spark)
    events = event_rows(spark, sf_dir, _names(spec))
    history = history_rows(spark, sf_dir)
    write_report(spec, events, history.where(F.lit(False)), table, folder)
    write_report(spec, events, history, table, folder)
    return spark.table(table)


def refreshed(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six reports refreshed; one of them as read back from its table."""
    run, folder = uuid.uuid4().hex[:12], _folder(spark)
    history = history_rows(spark, sf_dir)
    written = refresh_all(
        spark,
        event_rows(spark, sf_dir),
        {report: history for report in REPORTS},
        {report: f"{spec.output_table}_{run}" for report, spec in REPORTS.items()},
        location=folder,
        folder=folder,
    )
    return spark.table(written[name])


# ------------------------------------------------------------------ event rows


def struct_field_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_rows(spark, sf_dir).select(
        "event_name",
        F.col("traffic_source.name").alias("campaign"),
        F.col("traffic_source.source").alias("source"),
        F.col("device.category").alias("device"),
    )


def filter_event_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = event_rows(spark, sf_dir)
    return only_events(events, SESSION_REPORT_EVENTS).select(
        "event_date",
        "event_name",
        F.col("event_bundle_sequence_id").alias("session_id"),
    )


def event_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_event_flags(event_rows(spark, sf_dir)).select(
        "event_name",
        F.col("event_bundle_sequence_id").alias("session_id"),
        "is_page_view",
        "is_session_start",
        "is_purchase",
    )


def dates_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_rows(spark, sf_dir).select(
        "event_date", parse_event_date(F.col("event_date")).alias("date")
    )


def items_of_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = event_rows(spark, sf_dir)
    return unnest_items(only_events(events, PRODUCT_EVENTS))


# ------------------------------------------------------- aggregates and joins


def left_join_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.session_report_by_joins(
        event_rows(spark, sf_dir, SESSION_REPORT_EVENTS)
    )


def left_join_date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.session_report_by_joins(
        event_rows(spark, sf_dir, SESSION_REPORT_EVENTS), *CAMPAIGN, "source_type"
    )


def session_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.session_counts(event_rows(spark, sf_dir), *CAMPAIGN)


def pageview_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.pageview_counts(event_rows(spark, sf_dir), *CAMPAIGN)


def coalesce_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = session_counts(spark, sf_dir)
    views = pageview_counts(spark, sf_dir)
    return sessions.join(views, ["date", "campaign"], "left").select(
        "date",
        "campaign",
        F.coalesce("pageviews", F.lit(0)).alias("pageviews"),
    )


def count_if_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.dated(event_rows(spark, sf_dir), None, None)
    return rows.groupBy("date").agg(
        F.count_if(is_event(PAGE_VIEW)).alias("page_views"),
        F.count_if(is_event(USER_ENGAGEMENT)).alias("engagements"),
    )


def session_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.session_metrics(event_rows(spark, sf_dir), *CAMPAIGN)


def bounce_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.bounce_rates(session_metrics(spark, sf_dir), "campaign")


def count_distinct_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = purchased_items(event_rows(spark, sf_dir))
    return items.groupBy("date", "product").agg(
        F.count_distinct("session_id").alias("unique_purchases")
    )


def sum_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = purchased_items(event_rows(spark, sf_dir))
    return items.groupBy("date", "product").agg(
        F.sum("quantity").alias("product_revenue")
    )


def union_all_widen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_report(
        REPORTS["ecommerce"],
        event_rows(spark, sf_dir, PRODUCT_EVENTS),
        history_rows(spark, sf_dir),
        in_order=False,
    )


# ------------------------------------------------------------ history cleaning


def cast_ua_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    # An instant late on the same day in UTC.
    late = F.expr("timestamp_seconds(unix_date(cast(date AS date)) * 86400L + 84600)")
    return history_rows(spark, sf_dir).select(
        F.col("date").alias("text"),
        history_date(F.col("date")).alias("date"),
        history_date(late, T.TimestampType()).alias("day_of_time"),
    )


def strip_nnbsp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_rows(spark, sf_dir).select(
        strip_separator(F.col("sessions")).alias("sessions"),
        strip_separator(F.col("product_revenue")).alias("product_revenue"),
    )


def integers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_rows(spark, sf_dir).select(
        clean_int(F.col("sessions")).alias("sessions"),
        clean_int(F.col("pageviews")).alias("pageviews"),
    )


def doubles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_rows(spark, sf_dir).select(
        clean_double(F.col("unique_purchases")).alias("unique_purchases"),
        clean_double(F.col("product_revenue")).alias("product_revenue"),
    )


def regexp_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_rows(spark, sf_dir).select(
        "bounce_rate", F.col("bounce_rate").rlike(NUMBER_LIKE).alias("number_like")
    )


def bounce(times: int, over: int, spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_rows(spark, sf_dir).select(
        F.col("bounce_rate").alias("text"),
        parse_bounce(F.col("bounce_rate"), times, over).alias("bounce_rate"),
    )


QUERIES: dict[str, Query] = {
    "scan_ga4_events": scan_ga4_events,
    "scan_ua_history": scan_ua_history,
    "sink_replace_table": sink_replace_table,
    "struct_field_access": struct_field_access,
    "filter_event_in": filter_event_in,
    "event_flags": event_flags,
    "parse_event_date": dates_of_events,
    "unnest_items": items_of_purchases,
    "left_join_date": left_join_date,
    "left_join_date_dim": left_join_date_dim,
    "session_counts": session_counts,
    "pageview_counts": pageview_counts,
    "coalesce_zero": coalesce_zero,
    "count_if_events": count_if_events,
    "session_metrics": session_metrics,
    "bounce_rate": bounce_rate,
    "count_distinct_purchases": count_distinct_purchases,
    "sum_quantity": sum_quantity,
    "union_all_widen": union_all_widen,
    "order_report": partial(report, "campaign"),
    "cast_ua_date": cast_ua_date,
    "strip_nnbsp": strip_nnbsp,
    "clean_int": integers,
    "clean_double": doubles,
    "regexp_guard": regexp_guard,
    "parse_ua_bounce_x100": partial(bounce, 100, 1),
    "parse_ua_bounce_x10": partial(bounce, 10, 1),
    "parse_ua_bounce_div100": partial(bounce, 1, 100),
    "ga4_all_session_reports": all_session_reports,
    **{f"ga4_{name}": partial(recent_half, name) for name in REPORTS},
    **{f"ua_{name}": partial(history_half, name) for name in REPORTS},
    **{f"report_{name}": partial(report, name) for name in REPORTS},
    **{f"refresh_{name}": partial(refreshed, name) for name in REPORTS},
}
