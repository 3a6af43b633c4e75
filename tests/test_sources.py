from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from erabridge import REPORTS, ga4_half, ua_half
from erabridge.schema import EVENT_SCHEMA
from erabridge.session import settings_for
from erabridge.sources.events import (
    DAILY_SHARDS,
    read_event_shards,
    read_partitioned_events,
)
from erabridge.sources.history import read_history
from erabridge.sources.shared import fresh_path, shared_folder
from helpers import event, event_table


@pytest.fixture
def shards(spark, tmp_path):
    for name, day in [
        ("events_20240101", "20240101"),
        ("events_20240102", "20240102"),
        ("events_intraday_20240103", "20240103"),
        ("pseudonymous_20240101", "20240101"),
    ]:
        rows = event_table(spark, [event(day, "page_view", 1, "a")])
        rows.write.parquet(f"{tmp_path}/{name}")
    # An old shard, from before the item list and with a field since dropped.
    old = event_table(spark, [event("20231231", "page_view", 2, "b")])
    old.drop("items").withColumn("legacy", F.lit(1)).write.parquet(
        f"{tmp_path}/events_20231231"
    )
    return str(tmp_path)


def days(df):
    return sorted(row.event_date for row in df.select("event_date").collect())


def test_all_shards_with_the_prefix(spark, shards):
    events = read_event_shards(spark, shards)
    assert days(events) == ["20231231", "20240101", "20240102", "20240103"]
    assert events.schema == EVENT_SCHEMA


def test_finished_days_only(spark, shards):
    events = read_event_shards(spark, shards, DAILY_SHARDS)
    assert days(events) == ["20231231", "20240101", "20240102"]


def test_shards_of_different_shape_read_as_one(spark, shards):
    row = read_event_shards(spark, shards).where("event_date = '20231231'").first()
    assert row["items"] is None and row["traffic_source"]["name"] == "b"


def test_partitioned_days_stay_text_and_prune(spark, tmp_path):
    rows = [event(d, "page_view", 1, "a") for d in ("20240101", "20240102", "20240103")]
    path = f"{tmp_path}/events"
    event_table(spark, rows).write.partitionBy("event_date").parquet(path)
    events = read_partitioned_events(spark, path)
    assert dict(events.dtypes)["event_date"] == "string"
    some = events.where(F.col("event_date") >= "20240102")
    assert days(some) == ["20240102", "20240103"]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_history_by_table_or_path(spark, tmp_path):
    rows = spark.createDataFrame([("2020-01-01", "1")], "date string, sessions string")
    rows.write.parquet(f"{tmp_path}/h")
    rows.write.mode("overwrite").saveAsTable("history_by_name")
    by_path = read_history(spark, path=f"{tmp_path}/h")
    assert by_path.collect() == read_history(spark, "history_by_name").collect()
    with pytest.raises(ValueError, match="table name or a path"):
        read_history(spark)


def test_shared_folder_is_the_sessions(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_days_stored_as_numbers_give_the_same_report(spark, tmp_path):
    events = event_table(
        spark,
        [event("20240101", n, 1, "a") for n in ("session_start", "page_view")],
    )
    events.withColumn("event_date", F.col("event_date").cast("bigint")).write.parquet(
        f"{tmp_path}/events_20240101"
    )
    fields = [
        T.StructField("event_date", T.LongType()) if f.name == "event_date" else f
        for f in EVENT_SCHEMA
    ]
    stored = read_event_shards(spark, str(tmp_path), schema=T.StructType(fields))
    spec = REPORTS["campaign"]
    assert ga4_half(spec, stored).collect() == ga4_half(spec, events).collect()


def test_shards_in_another_format(spark, tmp_path):
    rows = [event("20240101", "purchase", 1, "a", items=[("mug", 2)])]
    event_table(spark, rows).write.json(f"{tmp_path}/events_20240101")
    events = read_event_shards(spark, str(tmp_path), fmt="json")
    assert events.first()["items"][0]["item_name"] == "mug"


class FakeSession:
    """A session on a cluster whose default file system is the machine's own."""

    class sparkContext:
        master = "yarn"

        class _jsc:
            class hadoopConfiguration:
                @staticmethod
                def get(key):
                    return "file:///"

        @staticmethod
        def getConf():
            return {}

        @staticmethod
        def getCheckpointDir():
            return None

    class conf:
        @staticmethod
        def get(key, default):
            return default


def test_a_cluster_session_must_name_the_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(FakeSession())


@pytest.mark.parametrize("folder", ["file:/data/x", "file:///data/x", "/data/x"])
def test_a_cluster_session_refuses_a_folder_of_one_machine(folder):
    with pytest.raises(ValueError, match="can't share"):
        shared_folder(FakeSession(), folder)


@pytest.mark.parametrize("folder", ["hdfs://n/x", "s3a://bucket/x/"])
def test_a_cluster_session_takes_a_folder_of_a_shared_store(folder):
    assert shared_folder(FakeSession(), folder) == folder.rstrip("/")


class FakeSessionOfShare(FakeSession):
    """It names a folder that is mounted on all machines of the cluster."""

    class conf:
        @staticmethod
        def get(key, default):
            return "file:///mnt/share/" if key == "spark.checkpoint.dir" else default


@pytest.mark.parametrize(
    "folder", [None, "file:///mnt/share", "/mnt/share/", "file:/mnt/share/run"]
)
def test_a_cluster_session_takes_the_mounted_folder_that_it_names(folder):
    taken = shared_folder(FakeSessionOfShare(), folder)
    assert taken == (folder or "file:///mnt/share/").rstrip("/")


@pytest.mark.parametrize(
    "folder", ["file:/mnt/shared", "/mnt", "/mnt/share/../x", "file:/data/x"]
)
def test_a_cluster_session_refuses_folders_beside_the_named_one(folder):
    with pytest.raises(ValueError, match="can't share"):
        shared_folder(FakeSessionOfShare(), folder)


class FakeSessionOfWarehouse(FakeSession):
    """It names no folder for checkpoints; its tables lie on a mounted folder."""

    class conf:
        @staticmethod
        def get(key, default):
            return "file:/mnt/tables" if key == "spark.sql.warehouse.dir" else default


@pytest.mark.parametrize("master", ["spark://n:7077", "local-cluster[3,2,900]"])
def test_a_session_without_a_shared_folder_takes_its_warehouse(monkeypatch, master):
    monkeypatch.setattr(FakeSession.sparkContext, "master", master)
    taken = shared_folder(FakeSessionOfWarehouse())
    assert taken == "file:/mnt/tables"
    assert fresh_path(FakeSessionOfWarehouse(), "x", taken).startswith(f"{taken}/x-")


def test_a_session_of_one_process_must_name_the_shared_folder(monkeypatch):
    monkeypatch.setattr(FakeSession.sparkContext, "master", "local[4]")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(FakeSessionOfWarehouse())


def test_the_shared_folder_is_looked_up_without_a_change(spark, tmp_path):
    before = spark.sparkContext.getCheckpointDir()
    assert fresh_path(spark, "x", f"{tmp_path}/").startswith(f"{tmp_path}/x-")
    assert spark.sparkContext.getCheckpointDir() == before


def test_shards_of_some_days_only_are_listed(spark, shards):
    first, last = date(2023, 12, 31), date(2024, 1, 3)
    some = read_event_shards(spark, shards, days=(date(2024, 1, 2), last))
    assert days(some) == ["20240102", "20240103"]
    assert {f.split("/")[-2] for f in some.inputFiles()} == {
        "events_20240102",
        "events_intraday_20240103",
    }
    done = read_event_shards(spark, shards, DAILY_SHARDS, days=(first, last))
    assert days(done) == ["20231231", "20240101", "20240102"]


def test_a_spreadsheet_s_history_gives_the_rows_of_a_stored_one(spark, tmp_path):
    rows = [("2024-01-05", "1\u202f234", "7", "0,5"), ("2024-01-06", "3", "4", "<0.01%")]
    columns = ["date", "sessions", "pageviews", "bounce_rate"]
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/h")
    (tmp_path / "h.csv").write_text(
        "\n".join(";".join(r) for r in [columns, *rows]), encoding="utf-8"
    )
    csv = read_history(
        spark, path=f"{tmp_path}/h.csv", fmt="csv", options={"header": "true", "sep": ";"}
    )
    stored = read_history(spark, path=f"{tmp_path}/h")
    spec = REPORTS["traffic"]
    assert sorted(ua_half(spec, csv).collect()) == sorted(ua_half(spec, stored).collect())


FIRST_COUNT = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_shuffle_partitions_grow_with_the_job():
    small, large = settings_for(10**6, 8), settings_for(10**13, 8000)
    assert small[FIRST_COUNT] == "8"
    assert int(large[FIRST_COUNT]) > 70_000


def test_splits_follow_what_is_read_and_blocks_stay_readable():
    small = settings_for(10**13, 8000, stored_bytes=10**14, read_share=0.1)
    assert small["spark.sql.files.maxPartitionBytes"] == str(10 * 16 * 1024**2)
    wide = settings_for(10**13, 8000, 10**14, 0.1, split_bytes=128 * 1024**2)
    split = int(wide["spark.sql.files.maxPartitionBytes"])
    assert split == 10 * 128 * 1024**2
    blocks = int(wide[FIRST_COUNT]) * 10**14 / split
    assert 10**13 / blocks > 10_000
    assert 10**13 / int(wide[FIRST_COUNT]) <= 1024**3
