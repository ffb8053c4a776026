"""Connected components of an edge table by alternating large-star and small-star steps; no link leaves the executors.

Minima are combined before each exchange, and the joins back are plain equi-joins that adaptive execution can split, so a
node with very many neighbours doesn't need a task of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize_narrow


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a < b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    joined = edges.join(least, "b")
    return joined.select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b")).filter("a < b").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b: long); root is the smallest node of its component.

    Null ends and loops are left out; repeated edges count once; an empty table gives no rows.
    """
    now = materialize_narrow(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        now = materialize_narrow(_small_star(materialize_narrow(_large_star(now), "edges")), "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def with_least(found: DataFrame, values: DataFrame, share: int = 1000) -> DataFrame:
    """(node, root, component): ``found`` with the least least_id of each component. ``found``: a written table of :func:`components`;
    ``values``: node, least_id.

    Minima are combined before the exchange. Components with more than one node in ``share`` are at most ``share``, so these are sent
    to all tasks, and no task gets a large component's nodes; only the others' nodes are dealt by root.
    """
    by_root = materialize_narrow(values.join(found, "node").groupBy("root").agg(F.min("least_id").alias("component"), F.count("*").alias("size")), "component-minima")
    large = F.broadcast(by_root.filter(F.col("size") * share > found.count()).select("root", "component"))
    rest = found.join(large.select("root"), "root", "left_anti").join(by_root.select("root", "component"), "root")
    return found.join(large, "root").unionByName(rest).select("node", "root", "component")
