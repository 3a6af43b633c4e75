"""Queries that write tables, in a session on a cluster with a mounted shared folder."""

from datetime import datetime

import pytest

from erabridge import REPORTS
from workload.adapters import EVENTS_TABLE, ORDERS_TABLE
from workload.queries import QUERIES


@pytest.fixture
def stored(spark, tmp_path):
    """Events with every type, null times and users; orders of two days, one null."""
    kinds = ["view", "signup", "click", "purchase", None]
    spark.createDataFrame(
        [
            (
                n,
                datetime(2024, 1, 1 + n % 3, 12) if n % 13 else None,
                n % 9 if n % 11 else None,
                kinds[n % 5],
                f'{{"k": {n % 10}}}',
            )
            for n in range(1, 200)
        ],
        EVENTS_TABLE,
    ).write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame(
        [
            (n, n % 8, 900.0 + n, datetime(2023, 5, 1 + n % 2) if n % 7 else None)
            for n in range(1, 40)
        ],
        ORDERS_TABLE,
    ).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


@pytest.fixture
def on_cluster(spark, monkeypatch):
    """The session says that it is a cluster's; its shared folder has no store."""
    monkeypatch.setattr(spark.sparkContext, "master", "spark://driver:7077")
    assert spark.conf.get("spark.checkpoint.dir").startswith("/")


def counted(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def test_sink_writes_to_the_mounted_folder(spark, stored, on_cluster):
    written = QUERIES["sink_replace_table"](spark, stored)
    assert counted(written) == counted(QUERIES["report_traffic"](spark, stored))
    shared = spark.conf.get("spark.checkpoint.dir")
    assert all(shared in file for file in written.inputFiles())


@pytest.mark.parametrize("name", REPORTS)
def test_refresh_works_in_the_mounted_folder(spark, stored, on_cluster, name):
    written = QUERIES[f"refresh_{name}"](spark, stored)
    assert counted(written) == counted(QUERIES[f"report_{name}"](spark, stored))
    shared = spark.conf.get("spark.checkpoint.dir")
    assert all(shared in file for file in written.inputFiles())
