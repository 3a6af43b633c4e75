"""The test tables seen as event rows and as an exported history.

``FIXTURES.md`` section 3 is the specification.
"""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from erabridge.functions.numbers import NARROW_NO_BREAK_SPACE
from erabridge.sources.events import read_event_shards
from erabridge.sources.history import read_history

EVENTS_TABLE = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("props", T.StringType()),
    ]
)

ORDERS_TABLE = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
    ]
)

EVENT_NAMES = {
    "view": "page_view",
    "signup": "session_start",
    "click": "user_engagement",
}


def event_rows(
    spark: SparkSession, sf_dir: str, names: Iterable[str] | None = None
) -> DataFrame:
    """``events`` in the shape of tracked web events.

    A caller that will keep only some event names may say so: the test is then
    made on the stored ``event_type``, where Parquet can skip by it.
    """
    raw = read_event_shards(spark, sf_dir, "events*", EVENTS_TABLE)
    if names is not None:
        raw = raw.where(F.col("event_type").isin(*_stored_names(names)))
    # A column of its own, so that each row's text is searched only once.
    raw = raw.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return raw.select(
        _but_each(97, _compact_day(F.col("ts"))).alias("event_date"),
        _event_name(F.col("event_type")).alias("event_name"),
        _but_each(89, F.col("user_id")).alias("event_bundle_sequence_id"),
        F.struct(
            F.when(
                (F.col("event_type") == "view") & (F.col("event_id") % 83 == 0),
                "camp_unstarted",
            )
            .otherwise(_numbered("camp_", F.col("k") % 5))
            .alias("name"),
            _numbered("src_", F.col("user_id") % 7).alias("source"),
        ).alias("traffic_source"),
        F.struct(
            _device(F.col("user_id")).alias("category"),
            F.concat(F.lit("os_"), (F.col("k") % 2).cast("string")).alias(
                "operating_system"
            ),
        ).alias("device"),
        _items().alias("items"),
    )


def history_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as one export with the columns of all six histories."""
    orders = read_history(
        spark, path=f"{sf_dir}/orders.parquet", schema=ORDERS_TABLE
    )
    amount = F.floor("o_totalprice").cast("bigint")
    source = _numbered("src_", F.col("o_custkey") % 7)
    return orders.select(
        F.col("o_orderdate").cast("date").cast("string").alias("date"),
        _numbered("camp_", F.col("o_custkey") % 5).alias("campaign"),
        source.alias("channelgrouping"),
        source.alias("source"),
        _device(F.col("o_custkey")).alias("device"),
        F.concat(F.lit("sku_"), (F.col("o_custkey") % 20).cast("string")).alias(
            "product"
        ),
        _grouped(amount).alias("sessions"),
        _grouped(amount * 2).alias("pageviews"),
        _grouped(amount).alias("unique_purchases"),
        _grouped(amount * 3).alias("product_revenue"),
        _bounce_text().alias("bounce_rate"),
    )


def _stored_names(names: Iterable[str]) -> list[str]:
    wanted = set(names)
    return sorted(
        wanted | {old for old, new in EVENT_NAMES.items() if new in wanted}
    )


def _event_name(event_type: Column) -> Column:
    name = event_type
    for old, new in EVENT_NAMES.items():
        name = F.when(event_type == old, new).otherwise(name)
    return name


def _but_each(n: int, value: Column) -> Column:
    """``value``, but NULL in one of ``n`` events."""
    return F.when(F.col("event_id") % n != 0, value)


def _compact_day(ts: Column) -> Column:
    return F.replace(ts.cast("date").cast("string"), F.lit("-"), F.lit(""))


def _numbered(prefix: str, number: Column) -> Column:
    return F.when(number != 0, F.concat(F.lit(prefix), number.cast("string")))


def _device(key: Column) -> Column:
    return (
        F.when(key % 3 == 0, "desktop")
        .when(key % 3 == 1, "mobile")
        .when(key % 3 == 2, "tablet")
    )


def _item(offset: int) -> Column:
    number = F.col("event_id") + offset
    return F.struct(
        F.concat(F.lit("sku_"), (number % 20).cast("string")).alias("item_name"),
        F.when(number % 11 != 0, 1 + number % 3).alias("quantity"),
    )


def _items() -> Column:
    kind = F.col("event_id") % 4
    one = F.array(_item(0))
    return (
        F.when(kind == 0, F.slice(one, 1, 0))
        .when(kind == 1, one)
        .when(kind == 2, F.array(_item(0), _item(7)))
    )


def _grouped(number: Column) -> Column:
    thousands = F.concat(
        F.floor(number / 1000).cast("string"),
        F.lit(NARROW_NO_BREAK_SPACE),
        F.lpad((number % 1000).cast("string"), 3, "0"),
    )
    return F.when(number < 1000, number.cast("string")).otherwise(thousands)


def _bounce_text() -> Column:
    kind = F.col("o_orderkey") % 6
    return (
        F.when(kind == 0, "<0.01%")
        .when(kind == 1, "0,4567")
        .when(kind == 2, "0.45")
        .when(kind == 3, "(not set)")
        .when(kind == 4, "")
    )
