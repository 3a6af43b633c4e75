"""The six daily reports: what differs between them, how to build and write them."""

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from erabridge.operators.history import (
    clean_product_history,
    clean_session_history,
)
from erabridge.operators.events import events_of_days
from erabridge.operators.layout import for_writing, ordered_union, union_eras
from erabridge.operators.products import product_report
from erabridge.operators.sessions import TOTAL, session_report, session_reports
from erabridge.sources.shared import fresh_path, remove_folder
from erabridge.sources.sink import refuse_view, replace_table, stage, swap_all


@dataclass(frozen=True)
class ReportSpec:
    """One report.

    ``dim`` is its dimension column, ``event_field`` where events hold it. A
    history bounce rate is multiplied by ``times / over``. ``label`` is the
    column telling the eras apart. ``products`` marks the report of products
    sold, which has its own figures and no bounce rate.
    """

    name: str
    dim: str | None
    event_field: str | None
    label: str
    times: int = 100
    over: int = 1
    products: bool = False

    @property
    def keys(self) -> list[str]:
        return ["date", self.dim] if self.dim else ["date"]

    @property
    def output_table(self) -> str:
        return f"{self.name}_product_ua_ga4" if self.products else f"{self.name}_ua_ga4"

    @property
    def history_columns(self) -> list[str]:
        if self.products:
            return [*self.keys, "unique_purchases", "product_revenue"]
        return [*self.keys, "sessions", "pageviews", "bounce_rate"]


# Dimensions, label columns and bounce scales. That the scales
# differ is part of the reports' definition.
REPORTS = {
    spec.name: spec
    for spec in (
        ReportSpec("traffic", None, None, "source"),
        ReportSpec("campaign", "campaign", "traffic_source.name", "source_type"),
        ReportSpec(
            "channelgrouping",
            "channelgrouping",
            "traffic_source.source",
            "source",
            times=10,
        ),
        ReportSpec("ecommerce", "product", None, "source_type", products=True),
        ReportSpec("sources", "source", "traffic_source.source", "source_type"),
        ReportSpec(
            "device", "device", "device.category", "source", times=1, over=100
        ),
    )
}


def ga4_half(spec: ReportSpec, events: DataFrame) -> DataFrame:
    """The report's rows from events."""
    if spec.products:
        return product_report(events, spec.label)
    return session_report(events, spec.dim, spec.event_field, spec.label)


def ua_half(spec: ReportSpec, history: DataFrame) -> DataFrame:
    """The report's rows from its cleaned history."""
    if spec.products:
        return clean_product_history(history, spec.label)
    return clean_session_history(
        history, spec.dim, spec.times, spec.over, spec.label
    )


def build_report(
    spec: ReportSpec,
    events: DataFrame,
    history: DataFrame,
    in_order: bool = True,
    days: tuple[date, date] | None = None,
) -> DataFrame:
    """Both halves as one table, by default sorted by date and dimension.

    ``days``, first and last, leaves out all other days, and rows without one.
    The test is made on either input, before the halves meet: a filter on the
    finished report can't pass a sort's split of the history.
    """
    if days is not None:
        events = events_of_days(events, *days)
    recent, older = ga4_half(spec, events), ua_half(spec, history)
    if days is not None:
        older = older.where(F.col("date").between(*days))
    if in_order:
        return ordered_union(recent, older, spec.keys)
    return union_eras(recent, older)


def write_report(
    spec: ReportSpec,
    events: DataFrame,
    history: DataFrame,
    table: str | None = None,
    location: str | None = None,
) -> str:
    """Build one report and replace its table; returns the table's name."""
    report = build_report(spec, events, history, in_order=False)
    table = table or spec.output_table
    replace_table(for_writing(report, spec.keys), table, location)
    return table


def session_summary(events: DataFrame, path: str) -> DataFrame:
    """All session reports' event halves from one scan, as a table at ``path``.

    The table has a row per report, day and dimension value. Storing it in the
    shared folder means that the reports built from it, and any task rerun
    after an executor is lost, never return to the events.
    """
    fields = {
        spec.event_field for spec in REPORTS.values() if spec.event_field
    }
    dims = {_summary_name(field): field for field in sorted(fields)}
    session_reports(events, dims).write.parquet(path)
    return events.sparkSession.read.parquet(path)


def ga4_half_from_summary(spec: ReportSpec, summary: DataFrame) -> DataFrame:
    """Same rows as ``ga4_half`` for a session report."""
    kind = _summary_name(spec.event_field) if spec.event_field else TOTAL
    dims = [F.col("value").alias(spec.dim)] if spec.dim else []
    return summary.where(F.col("dimension") == kind).select(
        "date",
        *dims,
        "sessions",
        "pageviews",
        "bounce_rate",
        F.lit("GA4").alias(spec.label),
    )


def refresh_all(
    spark: SparkSession,
    events: DataFrame,
    histories: Mapping[str, DataFrame],
    tables: Mapping[str, str] | None = None,
    location: str | None = None,
    folder: str | None = None,
) -> dict[str, str]:
    """Replace all six tables, or none, with two scans of the events.

    ``histories`` maps report names to history tables. ``tables`` may rename
    outputs, ``location`` is as in ``replace_table``. The summary of the events
    lies in ``folder``, or else in the session's shared one, while this runs.
    Returns the table name of each report.

    Inputs and names are checked before the first scan. All six staging tables
    are written before any takes its table's place.
    """
    written = {n: (tables or {}).get(n, s.output_table) for n, s in REPORTS.items()}
    _check_inputs(events, histories, tables or {})
    for table in written.values():
        refuse_view(spark, table)
    path, staged = fresh_path(spark, "session-summary", folder), []
    try:
        summary = session_summary(events, path)
        for name, spec in REPORTS.items():
            if spec.products:
                recent = ga4_half(spec, events)
            else:
                recent = ga4_half_from_summary(spec, summary)
            report = union_eras(recent, ua_half(spec, histories[name]))
            report = for_writing(report, spec.keys)
            staged.append(stage(report, written[name], location))
    except Exception:
        for one in staged:
            one.finish()
        raise
    finally:
        remove_folder(spark, path)
    swap_all(staged)
    return written


def _check_inputs(
    events: DataFrame,
    histories: Mapping[str, DataFrame],
    tables: Mapping[str, str],
) -> None:
    if unknown := sorted({*histories, *tables} - {*REPORTS}):
        raise ValueError(f"no such report: {', '.join(unknown)}")
    if missing := sorted({*REPORTS} - {*histories}):
        raise ValueError(f"no history for: {', '.join(missing)}")
    names = [tables.get(n, s.output_table) for n, s in REPORTS.items()]
    if len({*names}) < len(names):
        raise ValueError("two reports have the same table")
    for name, spec in REPORTS.items():
        # Analysis alone; nothing runs.
        ua_half(spec, histories[name].select(*spec.history_columns))
        ga4_half(spec, events)


def _summary_name(event_field: str) -> str:
    return event_field.replace(".", "_")

