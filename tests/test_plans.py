"""The physical plans: what is read, shuffled and kept out of Python."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from erabridge import (
    REPORTS,
    build_report,
    ga4_half,
    read_partitioned_events,
    ua_half,
)
from erabridge.operators.sessions import session_report_by_joins, session_reports
from helpers import event, event_table, plan_of
from workload.adapters import event_rows, history_rows
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def wide_events(spark, tmp_path_factory):
    """Stored events with far more fields than the reports need."""
    path = str(tmp_path_factory.mktemp("wide") / "events")
    rows = [event("20240101", "purchase", 1, "a", "os", [("mug", 1)])]
    wide_item = F.transform(
        "items",
        lambda i: F.struct(i.item_name, i.quantity, F.lit(1.5).alias("price")),
    )
    wide_source = F.struct("traffic_source.*", F.lit("m").alias("medium"))
    event_table(spark, rows).withColumns(
        {
            "items": wide_item,
            "traffic_source": wide_source,
            "event_params": F.lit("long text"),
        }
    ).write.partitionBy("event_date").parquet(path)
    return path


def read_schema(plan):
    return re.search(r"ReadSchema: struct<(.*)>", plan).group(1)


@pytest.mark.parametrize("name", [n for n, s in REPORTS.items() if not s.products])
def test_session_report_is_one_scan_two_shuffles_no_join(spark, wide_events, name):
    plan = plan_of(ga4_half(REPORTS[name], read_partitioned_events(spark, wide_events)))
    assert plan.count("FileScan parquet") == 1
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Join" not in plan
    assert "In(event_name, [page_view,session_start,user_engagement])" in plan
    assert plan.count("HashAggregate") == 4
    assert "SortAggregate" not in plan


def test_only_needed_fields_are_read(spark, wide_events):
    declared = read_partitioned_events(spark, wide_events)
    undeclared = spark.read.parquet(wide_events)
    for events in (declared, undeclared):
        schema = read_schema(plan_of(ga4_half(REPORTS["campaign"], events)))
        assert schema == (
            "event_name:string,event_bundle_sequence_id:bigint,"
            "traffic_source:struct<name:string>"
        )
        schema = read_schema(plan_of(ga4_half(REPORTS["ecommerce"], events)))
        assert "items:array<struct<item_name:string,quantity:bigint>>" in schema
        assert "traffic_source" not in schema and "price" not in schema


def test_product_report_shuffles_by_session_first(spark, wide_events):
    events = read_partitioned_events(spark, wide_events)
    plan = plan_of(ga4_half(REPORTS["ecommerce"], events))
    assert plan.count("FileScan parquet") == 1
    by_buyer = r"Exchange hashpartitioning\(date#\d+, product#\d+, session_id"
    assert re.search(by_buyer, plan)
    assert plan.count("Exchange hashpartitioning") == 2
    assert "EqualTo(event_name,purchase)" in plan


def test_all_session_reports_share_one_scan(spark, wide_events):
    events = read_partitioned_events(spark, wide_events)
    dims = {"campaign": "traffic_source.name", "device": "device.category"}
    plan = plan_of(session_reports(events, dims))
    assert plan.count("FileScan parquet") == 1
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Expand" in plan
    literal = plan_of(session_report_by_joins(events, "campaign", dims["campaign"]))
    assert literal.count("FileScan parquet") >= 3


def test_history_is_cleaned_without_a_shuffle(spark, sf_dir):
    for spec in REPORTS.values():
        plan = plan_of(ua_half(spec, history_rows(spark, sf_dir)))
        assert "Exchange" not in plan
        assert "WholeStageCodegen" in plan or "*(1)" in plan


def test_day_filter_reaches_the_partitions(spark, wide_events):
    events = read_partitioned_events(spark, wide_events)
    recent = ga4_half(REPORTS["traffic"], events.where("event_date >= '20240101'"))
    assert "PartitionFilters: [isnotnull(event_date" in plan_of(recent)


@pytest.mark.parametrize("name", REPORTS)
def test_day_filter_on_a_sorted_report_skips_event_folders(
    spark, wide_events, sf_dir, name
):
    events = read_partitioned_events(spark, wide_events)
    report = build_report(REPORTS[name], events, history_rows(spark, sf_dir))
    plan = plan_of(report.where("date >= date'2024-01-01'"))
    assert re.search(r"PartitionFilters: \[.{0,20}coalesce\(.*event_date#\d+", plan)


def test_day_range_reaches_both_inputs_of_a_sorted_report(spark, wide_events, tmp_path):
    history_path = f"{tmp_path}/history"
    rows = [("2024-01-01", "a", "1", "2", "0.5"), ("2024-01-07", "b", "1", "2", "0.5")]
    columns = ["date", "campaign", "sessions", "pageviews", "bounce_rate"]
    spark.createDataFrame(rows, columns).write.parquet(history_path)
    events = read_partitioned_events(spark, wide_events)
    days = (date(2024, 1, 5), date(2024, 1, 9))
    report = build_report(
        REPORTS["campaign"], events, spark.read.parquet(history_path), days=days
    )
    plan = plan_of(report)
    assert "event_date#" in re.search(r"PartitionFilters: \[(.*?)\], ", plan).group(1)
    filters = re.findall(r"DataFilters: \[(.*?)\], Format", plan)
    assert any("2024-01-05" in f and "2024-01-09" in f for f in filters)
    assert [row.date for row in report.collect()] == [date(2024, 1, 7)]


def test_no_query_leaves_the_jvm_or_pairs_rows(spark, sf_dir):
    for name, query in QUERIES.items():
        if name == "sink_replace_table" or name.startswith("refresh_"):
            continue
        plan = plan_of(query(spark, sf_dir))
        for node in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
            assert node not in plan, name


def test_events_are_skipped_by_type_at_the_scan(spark, sf_dir):
    plan = plan_of(QUERIES["report_campaign"](spark, sf_dir))
    assert "PushedFilters: [In(event_type, [click,page_view" in plan
    full = plan_of(event_rows(spark, sf_dir).select("event_name"))
    assert "PushedFilters: []" in full
