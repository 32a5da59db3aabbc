"""Connected components of an edge table, by passing the smallest label on and jumping along labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lingspan.tables import materialize


def components(edges: DataFrame) -> DataFrame:
    """(a, b) of any type with an order -> (node, component): the smallest node reachable. A node without an edge is not in
    it, an edge from a node to itself or with a null is none. Labels halve their way by the jumps, so rounds are few; each is
    written, and one number a round comes to the driver."""
    links = edges.where("a <> b").select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
    links = materialize(links.select("e.a", "e.b").distinct(), "links")
    state = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("component"))
    while True:
        state = materialize(state, "labels")
        heard = links.join(state.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("heard"))
        passed = state.join(heard, "node").select("node", F.least("component", "heard").alias("component"), (F.col("heard") < F.col("component")).alias("moved"))
        passed = materialize(passed, "labels")
        if passed.where("moved").isEmpty():
            return passed.select("node", "component")
        labels = passed.select(F.col("node").alias("component"), F.col("component").alias("next"))
        state = passed.join(labels, "component").select("node", F.least("component", "next").alias("component"))
