"""Event rows: daily shards under a common name prefix, or one dated table."""

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from erabridge.schema import EVENT_SCHEMA

ALL_SHARDS = "events_*"
DAILY_SHARDS = "events_[0-9]*"


def read_event_shards(
    spark: SparkSession,
    root: str,
    pattern: str = ALL_SHARDS,
    schema: T.StructType = EVENT_SCHEMA,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    days: tuple[date, date] | None = None,
) -> DataFrame:
    """Every shard under ``root`` whose name matches ``pattern``, as one table.

    The default takes all shards with the prefix, unfinished intraday ones
    included; ``DAILY_SHARDS`` takes the finished days only. With ``days``,
    first and last, only shards whose name ends in one of them are listed.
    ``options`` go to Spark's reader of the format.
    """
    reader = spark.read.format(fmt).schema(schema).options(**(options or {}))
    if days is not None:
        pattern = _shards_of_days(pattern, *days)
    return reader.load(f"{root}/{pattern}")


def _shards_of_days(pattern: str, first: date, last: date) -> str:
    stem = pattern.partition("[")[0].partition("*")[0]
    count = (last - first).days + 1
    names = [f"{first + timedelta(days=n):%Y%m%d}" for n in range(count)]
    if "[" not in pattern:
        names += [f"*_{name}" for name in names]
    return f"{stem}{{{','.join(names)}}}"


def read_partitioned_events(
    spark: SparkSession,
    root: str,
    schema: T.StructType = EVENT_SCHEMA,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Events laid out as ``root/event_date=yyyymmdd/``.

    A filter on ``event_date`` then skips whole folders.
    """
    reader = spark.read.format(fmt).schema(schema).options(**(options or {}))
    return reader.load(root)
