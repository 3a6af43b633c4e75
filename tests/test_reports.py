from pathlib import Path

import pytest
from pyspark.sql import functions as F

from erabridge import (
    REPORTS,
    build_report,
    ga4_half,
    refresh_all,
    ua_half,
    write_report,
)
from erabridge.operators.layout import for_writing, ordered_union
from erabridge.sources.sink import replace_table
from helpers import as_set
from workload.adapters import event_rows, history_rows

# Event halves at sf 0.001 and 0.01: rows, sessions, page views, mean bounce rate.
EVENT_TOTALS = {
    "0.001": {
        "traffic": (31, 199, 186, 30.228347),
        "campaign": (111, 199, 109, 32.037752),
        "channelgrouping": (128, 199, 73, 18.75),
        "sources": (128, 199, 73, 18.75),
        "device": (82, 199, 164, 28.292683),
    },
    "0.01": {
        "traffic": (31, 2017, 1961, 31.189384),
        "campaign": (155, 2017, 1510, 34.289582),
        "channelgrouping": (217, 2017, 1693, 27.785567),
        "sources": (217, 2017, 1693, 27.785567),
        "device": (93, 2017, 1961, 31.3814),
    },
}
PRODUCT_TOTALS = {"0.001": (128, 151, 289, 4), "0.01": (302, 1475, 2752, 2)}

SCHEMAS = {
    "traffic": "date date, sessions bigint, pageviews bigint, bounce_rate double,"
    " source string",
    "campaign": "date date, campaign string, sessions bigint, pageviews bigint,"
    " bounce_rate double, source_type string",
    "channelgrouping": "date date, channelgrouping string, sessions bigint,"
    " pageviews bigint, bounce_rate double, source string",
    "ecommerce": "date date, product string, unique_purchases double,"
    " product_revenue double, source_type string",
    "sources": "date date, source string, sessions bigint, pageviews bigint,"
    " bounce_rate double, source_type string",
    "device": "date date, device string, sessions bigint, pageviews bigint,"
    " bounce_rate double, source string",
}


@pytest.mark.parametrize("sf", EVENT_TOTALS)
def test_event_totals(spark, sf):
    events = event_rows(spark, f"/root/testdata/sf{sf}")
    for name, (rows, sessions, views, bounce) in EVENT_TOTALS[sf].items():
        got = (
            ga4_half(REPORTS[name], events)
            .agg(
                F.count("*"),
                F.sum("sessions"),
                F.sum("pageviews"),
                F.avg("bounce_rate"),
            )
            .first()
        )
        assert tuple(got)[:3] == (rows, sessions, views), name
        assert got[3] == pytest.approx(bounce, abs=1e-6), name
    got = (
        ga4_half(REPORTS["ecommerce"], events)
        .agg(
            F.count("*"),
            F.sum("unique_purchases"),
            F.sum("product_revenue"),
            F.count_if(F.col("product_revenue").isNull()),
        )
        .first()
    )
    assert tuple(got) == PRODUCT_TOTALS[sf]


def test_history_totals(spark, sf_dir):
    history = history_rows(spark, sf_dir)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    amount = orders.agg(F.sum(F.floor("o_totalprice").cast("bigint"))).first()[0]
    per_text = orders.count() / 6
    for name, spec in REPORTS.items():
        half = ua_half(spec, history)
        assert half.count() == orders.count()
        if spec.products:
            got = half.agg(F.sum("unique_purchases"), F.sum("product_revenue")).first()
            assert tuple(got) == (float(amount), 3.0 * amount)
            continue
        got = half.agg(
            F.sum("sessions"), F.sum("pageviews"), F.sum("bounce_rate")
        ).first()
        assert tuple(got)[:2] == (amount, 2 * amount)
        scale = spec.times / spec.over
        assert got[2] == pytest.approx(per_text * 0.9068 * scale), name


@pytest.mark.parametrize("name", REPORTS)
def test_schema_and_order(spark, sf_dir, name):
    spec = REPORTS[name]
    report = build_report(spec, event_rows(spark, sf_dir), history_rows(spark, sf_dir))
    expected = spark.createDataFrame([], SCHEMAS[name]).dtypes
    assert report.dtypes == expected
    rows = report.select(*spec.keys).collect()
    keys = [tuple((v is not None, v) for v in row) for row in rows]
    assert keys == sorted(keys)
    labels = report.select(spec.label).distinct()
    assert as_set(labels) == {("GA4",), ("UA",)}


def test_refresh_writes_what_each_report_builds(spark, sf_dir):
    events, history = event_rows(spark, sf_dir), history_rows(spark, sf_dir)
    written = refresh_all(spark, events, {name: history for name in REPORTS})
    assert written == {name: spec.output_table for name, spec in REPORTS.items()}
    assert written["ecommerce"] == "ecommerce_product_ua_ga4"
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    assert not list(folder.glob("session-summary-*"))
    for name, spec in REPORTS.items():
        built = build_report(spec, events, history, in_order=False)
        stored = spark.table(written[name])
        assert stored.dtypes == built.dtypes
        assert stored.exceptAll(built).isEmpty() and built.exceptAll(stored).isEmpty()


def test_writing_replaces_the_table(spark, sf_dir):
    spec = REPORTS["device"]
    events, history = event_rows(spark, sf_dir), history_rows(spark, sf_dir)
    table = write_report(spec, events, history, "device_again")
    first = spark.table(table).count()
    write_report(spec, events, history.where("device = 'mobile'"), "device_again")
    assert 0 < spark.table(table).count() < first
    assert not [t.name for t in spark.catalog.listTables() if "staging" in t.name]


def test_failed_build_keeps_the_old_table(spark, sf_dir):
    spec = REPORTS["traffic"]
    events, history = event_rows(spark, sf_dir), history_rows(spark, sf_dir)
    write_report(spec, events, history, "kept")
    before = spark.table("kept").count()
    with pytest.raises(Exception, match="not a valid "):
        write_report(spec, events, history.withColumn("sessions", F.lit("x")), "kept")
    assert spark.table("kept").count() == before
    assert not [t.name for t in spark.catalog.listTables() if "staging" in t.name]


def test_replacing_at_a_location_leaves_old_files_alone(spark, tmp_path):
    replace_table(spark.range(5), "placed", str(tmp_path))
    old = spark.table("placed").inputFiles()
    replace_table(spark.range(3), "placed", str(tmp_path))
    new = spark.table("placed")
    assert as_set(new) == {(0,), (1,), (2,)}
    assert all(str(tmp_path) in name for name in new.inputFiles())
    assert spark.read.parquet(*old).count() == 5


def test_table_may_feed_its_own_replacement(spark):
    replace_table(spark.range(5), "self_fed")
    replace_table(spark.table("self_fed").union(spark.range(5, 8)), "self_fed")
    assert as_set(spark.table("self_fed")) == {(i,) for i in range(8)}


def test_hot_day_of_equal_rows_is_written_by_several_tasks(spark):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        noise = F.sha2(F.col("id").cast("string"), 256)
        rows = spark.range(0, 30000, 1, 12).select(
            F.lit("2024-01-01").cast("date").alias("date"), noise.alias("campaign")
        )
        replace_table(for_writing(rows, ["date", "campaign"]), "hot_day")
        table = spark.table("hot_day")
        assert table.count() == 30000
        assert len(table.inputFiles()) > 2
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_copies_of_one_row_are_sorted_by_several_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = F.col("id") % 2 == 0
        start = F.lit("2024-01-01").cast("date")
        day = F.date_add(start, (F.col("id") % 31).cast("int"))
        rows = spark.range(0, 24000, 1, 12).select(
            F.when(hot, F.lit("2024-01-15").cast("date")).otherwise(day).alias("date"),
            F.when(hot, 0).otherwise(F.col("id")).alias("sessions"),
        )
        result = ordered_union(rows.where("sessions < 0"), rows, ["date"])
        assert result.columns == ["date", "sessions"]
        parts = result.groupBy(F.spark_partition_id()).count().collect()
        assert sum(p["count"] for p in parts) == 24000
        assert max(p["count"] for p in parts) < 9000
        dates = [row.date for row in result.collect()]
        assert dates == sorted(dates)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
