"""Connected components of an edge list, by alternating large and small stars.

Each step joins every vertex to the smallest vertex around it; both steps are a grouped minimum and a join, so no
neighbourhood is ever gathered in one row or task, and hubs are split like any other skewed join key. Each round's
edges are written to the shared folder. Rounds end when the edges no longer change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, apart


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """For each u: its neighbours (larger ones, or the others) become neighbours of the smallest of u and its neighbours."""
    if large:
        around = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = around.join(apart(least), "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select("v", "m").union(least.select(F.col("u").alias("v"), "m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u != v").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(u, v): each vertex of edges (u, v, of one ordered type) but the smallest of its component, with that smallest."""
    now = scratch.keep(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = _mark(now)
    while True:
        large = scratch.keep(_star(now, True))
        small = scratch.keep(_star(large, False))
        scratch.drop(now, large)
        now, before = small, mark
        mark = _mark(now)
        if mark == before:
            return now
