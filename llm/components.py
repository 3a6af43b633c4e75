"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import partitions, stored

#: Nodes whose least neighbours may be sent to all tasks.
BROADCAST_ROWS = 100_000


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b) but the roots themselves.

    A root is the smallest node that is reachable.

    Large-star and small-star steps alternate until every edge joins a node to its
    root; each step is a grouped minimum joined back. No edges give no rows; loops,
    repeated edges and edges with a null end change nothing.
    """
    ends = (F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
    edges = edges.where("a <> b").select(*ends).distinct()
    edges, state = stored(edges), None
    while (now := _state(edges)) != state:
        state = now
        edges = stored(_small_star(_large_star(edges, now[0]), now[0]))
    return edges


def _state(edges: DataFrame) -> tuple:
    """Changes whenever an edge does, for all practical purposes."""
    mark = F.xxhash64("node", "root")
    halves = (F.sum(mark.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftright(mark, 32)))
    return tuple(edges.agg(F.count("*"), *halves).first())


def _with_least(rows: DataFrame, least: DataFrame, count: int) -> DataFrame:
    """``rows`` (node, ...), of ``count`` edges, with their node's row of ``least``.

    A small ``least`` goes to all tasks. Of a large one those nodes do that have more
    than a task's share ``n`` of the rows, of which there are few; the centre of a star
    is no hot key then.
    """
    if 2 * count <= BROADCAST_ROWS:
        return rows.join(F.broadcast(least), "node").drop("n")
    share = 2 * count // partitions(rows.sparkSession) + 1
    hot, rest = least.where(F.col("n") > share), least.where(F.col("n") <= share)
    others = rows.join(F.broadcast(hot.select("node")), "node", "left_anti")
    found = others.join(rest, "node").unionByName(rows.join(F.broadcast(hot), "node"))
    return found.drop("n")


def _large_star(edges: DataFrame, count: int) -> DataFrame:
    """Joins each larger neighbour of a node to the smallest of its neighbourhood."""
    back = edges.select(F.col("root").alias("node"), F.col("node").alias("other"))
    around = edges.withColumnRenamed("root", "other").unionByName(back)
    least = around.groupBy("node").agg(
        F.least(F.min("other"), "node").alias("least"), F.count("*").alias("n")
    )
    larger = _with_least(around.where("other > node"), least, count)
    return larger.select(F.col("other").alias("node"), F.col("least").alias("root"))


def _small_star(edges: DataFrame, count: int) -> DataFrame:
    """Joins the smaller neighbours of a node, and itself, to the smallest of them."""
    least = edges.groupBy("node").agg(F.min("root").alias("least"), F.count("*").alias("n"))
    rest = _with_least(edges, least, count).where("root <> least")
    rest = rest.select(F.col("root").alias("node"), F.col("least").alias("root"))
    own = least.select("node", F.col("least").alias("root"))
    return rest.unionByName(own).distinct()
