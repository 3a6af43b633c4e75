"""Input schemas: only the fields the reports read.

Reading with a declared schema keeps wide exports cheap (undeclared columns and
struct fields never leave the Parquet file), fixes the type of a partition
column that would otherwise be inferred, and absorbs drift between shards: a
field missing from an old shard reads as NULL.
"""

from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_date", T.StringType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("event_bundle_sequence_id", T.LongType()),
        T.StructField(
            "traffic_source",
            T.StructType(
                [
                    T.StructField("name", T.StringType()),
                    T.StructField("source", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "device",
            T.StructType([T.StructField("category", T.StringType())]),
        ),
        T.StructField(
            "items",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("item_name", T.StringType()),
                        T.StructField("quantity", T.LongType()),
                    ]
                )
            ),
        ),
    ]
)
