"""Union of the eras, row order, and the layout of a written report."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TASK = "_task"


def union_eras(recent: DataFrame, history: DataFrame) -> DataFrame:
    """All rows of both, duplicates kept; BIGINT beside DOUBLE becomes DOUBLE."""
    return recent.unionByName(history)


def ordered_union(
    recent: DataFrame, history: DataFrame, keys: list[str]
) -> DataFrame:
    """``union_eras``, sorted by ``keys``, NULLs first.

    The remaining columns break ties, which lets the range shuffle split a day
    that holds much of the table. The history may hold copies of one row, which
    the number of their source task splits in turn. It does not depend on the
    order in which a task meets its rows, so a rerun task sends each row where
    it went before. ``recent`` has one row per key and needs none, which also
    keeps the way free for a filter on the report to reach the events.
    """
    rest = [name for name in recent.columns if name not in keys]
    report = union_eras(
        recent.withColumn(TASK, F.lit(0)),
        history.withColumn(TASK, F.spark_partition_id()),
    )
    return report.orderBy(*keys, *rest, TASK).drop(TASK)


def for_writing(report: DataFrame, keys: list[str]) -> DataFrame:
    """Rows gathered by day into files of even size, each sorted by ``keys``.

    A stored table has no row order, so a global sort would buy nothing over
    this. Rebalancing merges small days and splits a day too big for one task
    (adaptive execution does both), even if its rows are all alike.
    """
    return report.hint("rebalance", F.col("date")).sortWithinPartitions(*keys)
