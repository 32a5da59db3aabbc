"""Connected components of an edge table by alternating large-star and small-star steps, each a join and a grouping.

Every round is written to the shared folder. The tables hold only edges of linked nodes; nothing is collected but two
numbers a round. Hub nodes are aggregated before the shuffle and joined by AQE-splittable joins, so a node that a third
of all edges touch is no single task's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One step over edges (u, v), u > v."""
    both = edges if small else edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if small:
        moved = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
    else:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) long pairs -> (node, component): the smallest node reachable; nodes without edges don't appear."""
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        now = materialize(_star(_star(now, small=False), small=True), "edges")
        sign = now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if sign == seen:  # a fixed point: every node points at its component's smallest
            break
        seen = sign
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
