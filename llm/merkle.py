"""Merkle manifest of a table: a hash tree by pivoted slots, proofs for each row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import stored

#: Children of a node, and levels that one shuffle works out.
FANOUT = 2
LEVELS = 4
#: What of a row its leaf holds, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Ranges of places that may be sent to all tasks; more are joined by a shuffle.
BROADCAST_ROWS = 50_000

STEP = "array<struct<left: string, right: string>>"


def encoded(value: Column) -> Column:
    """``-`` for null, else the count of the value's UTF-8 bytes, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*texts: Column) -> Column:
    """SHA-256 of the texts one after the other, as lower-case hex; nulls are left out."""
    return F.sha2(F.concat_ws("", *texts).cast("binary"), 256)


def leaf(values: list[Column]) -> Column:
    return digest(*map(encoded, values))


def placed(nodes: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``nodes`` with ``place`` (from 0 within its key, by ``order``, null first) and the
    key's ``size``.

    The rows are sorted over all tasks, ties by a number of their own, so neither a
    key nor repeated rows gather in one task. A row's place is its number in its task
    plus the key's rows in earlier tasks.
    """
    numbered = stored(nodes.withColumn("_row", F.monotonically_increasing_id()))
    by = [F.col(c).asc_nulls_first() for c in (key, *order, "_row")]
    dealt = numbered.orderBy(*by).drop("_row").withColumn("_at", F.monotonically_increasing_id())
    dealt = stored(dealt).withColumn("_task", F.shiftright("_at", 33))
    parts = dealt.groupBy(key, "_task").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(key).orderBy("_task")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    size = F.sum("_n").over(Window.partitionBy(key))
    parts = stored(parts.select(key, "_task", "_first", before.alias("_before"), size.alias("size")))
    if parts.count() <= BROADCAST_ROWS:  # else there are that many keys
        parts = F.broadcast(parts)
    joined = dealt.join(parts, [key, "_task"])
    place = F.col("_before") + F.col("_at") - F.col("_first")
    return joined.withColumn("place", place).drop("_at", "_task", "_first", "_before")


def _name(level: int, slot: int) -> str:
    return f"node_{level}_{slot}"


def _pivot(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """A row for every ``fanout ** levels`` nodes (key, place, size, digest, row).

    Conditional aggregates spread the children over slot columns; concatenated
    columns are hashed, level by level, as long as the key has several nodes.
    """
    width = fanout**levels
    slot = F.pmod("place", F.lit(width))
    slots = []
    for s in range(width):
        for name, column in ((_name(0, s), "digest"), (f"row_{s}", "row")):
            slots.append(F.first(F.when(slot == s, F.col(column)), ignorenulls=True).alias(name))
    block = F.floor(F.col("place") / width).alias("place")
    table = nodes.groupBy("key", block).agg(F.max("size").alias("size"), *slots)
    for level in range(levels):
        above = {}
        for parent in range(fanout ** (levels - level - 1)):
            run = [F.col(_name(level, parent * fanout + i)) for i in range(fanout)]
            own = F.when(F.col("size") > fanout**level, digest(*run)).otherwise(run[0])
            above[_name(level + 1, parent)] = F.when(run[0].isNotNull(), own)
        table = table.withColumns(above)
    return table


def _grown(nodes: DataFrame, fanout: int, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Pivots from the leaves upward, and (key, digest) of each key's top."""
    left = nodes.agg(F.max("size")).first()[0] or 0
    rounds = []
    while True:
        table = stored(_pivot(nodes, fanout, levels))
        rounds.append(table)
        width = fanout**levels
        top = F.col(_name(levels, 0)).alias("digest")
        size = F.ceil(F.col("size") / width).alias("size")
        nodes = table.select("key", "place", size, top, F.lit(None).cast("int").alias("row"))
        left = -(-left // width)
        if left <= 1:
            return rounds, nodes.select("key", "digest")


def _paths(rounds: list[DataFrame], tops: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(key, place, digest, row, path, ...) of each leaf, from the ``tops`` (key, path, ...).

    A path has for each level what stands left and right of the own node among its
    parent's children: the slot columns without the own one.
    """
    width = fanout**levels
    rest = [c for c in tops.columns if c not in ("key", "path")]
    found = tops.withColumn("place", F.lit(0).cast("long"))
    for table in reversed(rounds):
        joined = table.join(found.select("key", "place", "path", *rest), ["key", "place"])
        children = []
        for s in range(width):
            steps = []
            for level in range(levels):
                at = s // fanout**level
                run = at - at % fanout
                left = [F.col(_name(level, i)) for i in range(run, at)]
                right = [F.col(_name(level, i)) for i in range(at + 1, run + fanout)]
                step = F.struct(
                    F.concat_ws("", *left).alias("left"), F.concat_ws("", *right).alias("right")
                )
                steps.append(F.when(F.col("size") > fanout**level, step))
            own = F.filter(F.array(*steps), lambda x: x.isNotNull()).cast(STEP)
            child = F.struct(
                (F.col("place") * width + s).alias("place"),
                F.col(_name(0, s)).alias("digest"),
                F.col(f"row_{s}").alias("row"),
                F.concat(own, F.col("path")).alias("path"),
            )
            children.append(F.when(F.col(_name(0, s)).isNotNull(), child))
        there = F.filter(F.array(*children), lambda x: x.isNotNull())
        found = joined.select("key", *rest, F.explode(there).alias("child")).select(
            "key", *rest, "child.*"
        )
    return found


def manifest(
    docs: DataFrame,
    carried: Mapping[str, Column],
    fields: tuple[str, ...] = FIELDS,
    group: str = "lang",
    order: str = "doc_id",
    fanout: int = FANOUT,
    levels: int = LEVELS,
) -> DataFrame:
    """A row for each row of ``docs``: ``carried``, leaf, subroot, root and path.

    The leaves of a group, by ``order``, form a tree; the groups' roots, by group,
    form the tree of the root. Null groups and orders are a group and a place of
    their own and come first; rows of one order stand by their leaves, so the tree
    doesn't depend on how the table is stored. Repeated rows are leaves each, a
    single leaf is its own root, other columns make no difference, and an empty
    table has an empty manifest. Only the root goes through the driver.
    """
    leaves = docs.select(
        encoded(F.col(group)).alias("key"),
        F.col(group).cast("string").alias("group"),
        F.col(order).alias("order"),
        leaf([F.col(c) for c in fields]).alias("digest"),
        F.struct(*(column.alias(name) for name, column in carried.items())).alias("row"),
    )
    nodes = placed(leaves, "key", ["order", "digest"])
    groups = nodes.where("place = 0").select("key", "group")
    rounds, tops = _grown(nodes, fanout, levels)
    subroots = stored(groups.join(tops, "key").withColumnRenamed("key", "row"))
    one = subroots.withColumn("key", F.lit(""))
    one = placed(one, "key", ["group"]).drop("group")
    upper, root = _grown(one, fanout, levels)
    row = root.first()
    start = root.select("key", F.array().cast(STEP).alias("path"))
    above = _paths(upper, start, fanout, levels)
    above = above.select(F.col("row").alias("key"), "path", F.col("digest").alias("subroot"))
    found = _paths(rounds, above, fanout, levels)
    return found.select(
        *(F.col("row")[name].alias(name) for name in carried),
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(row["digest"] if row else None).cast("string").alias("root"),
        "path",
    )


def proof(path: Column) -> Column:
    """All siblings' digests, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def folded(own: Column, path: Column) -> Column:
    """The root that a leaf and its siblings make."""
    return F.aggregate(path, own, lambda node, s: digest(s["left"], node, s["right"]))
