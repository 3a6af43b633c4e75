"""Daily web-statistics reports over two tracking eras, as PySpark DataFrames."""

from erabridge.plans.reports import (
    REPORTS,
    ReportSpec,
    build_report,
    ga4_half,
    refresh_all,
    ua_half,
    write_report,
)
from erabridge.sources.events import read_event_shards, read_partitioned_events
from erabridge.sources.history import read_history

__all__ = [
    "REPORTS",
    "ReportSpec",
    "build_report",
    "ga4_half",
    "read_event_shards",
    "read_history",
    "read_partitioned_events",
    "refresh_all",
    "ua_half",
    "write_report",
]
