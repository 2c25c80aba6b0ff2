"""Connected components of a distributed edge list, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netpulse.llm.common import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every vertex of ``edges`` (a, b): the smallest id of its component.

    Each round maps every vertex to its smallest neighbour or itself, follows that
    map once more, and contracts the edges.  A component that still has an edge
    loses at least one vertex in two rounds, in practice more than half of them, so
    the rounds grow with the logarithm of the longest chain.  Every round is
    written to the shared folder; nothing but row counts reaches the driver.
    """
    plain = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    current = stage(plain.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = stage(current.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("component", F.col("id")), "labels")
    while current.take(1):
        both = current.select("a", "b").union(current.select("b", "a"))
        nearest = stage(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.col("v")).alias("to")), "nearest")
        further = nearest.select(F.col("v").alias("mid"), F.col("to").alias("end"))
        step = stage(nearest.join(further, nearest["to"] == further["mid"]).select("v", F.col("end").alias("to")), "step")
        left, right = step.select(F.col("v").alias("a"), F.col("to").alias("na")), step.select(F.col("v").alias("b"), F.col("to").alias("nb"))
        moved = current.join(left, "a").join(right, "b").where("na <> nb")
        labels = stage(
            labels.join(step, labels["component"] == step["v"], "left").select("id", F.coalesce("to", "component").alias("component")), "labels"
        )
        current = stage(moved.select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b")).distinct(), "edges")
    return labels
