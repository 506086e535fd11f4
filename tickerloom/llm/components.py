"""Connected components by alternating large and small stars, on tables in shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import stored


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """One step: every node ties its larger (or not larger) neighbours to the least of all.

    Neighbours are aggregated before the shuffle; the join is a plain equi join, which Spark
    splits where one node has very many neighbours.
    """
    if small:
        near = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = (near.groupBy("u").agg(F.min("v").alias("m"))
             .select("u", F.least("u", "m").alias("m")))
    tied = near.join(least, "u")
    if small:
        out = tied.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        out = tied.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    return out.filter("a != b").distinct()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root): the least node reachable over ``edges`` (a, b), for nodes that have edges.

    Ends when a round changes nothing, after a number of rounds that grows with the logarithm
    of the edges. Edges may repeat and may join a node with itself.
    """
    current = stored(edges.filter("a != b").select("a", "b").distinct(), f"{label}-edges")
    seen = None
    while True:
        current = stored(_stars(_stars(current, small=False), small=True), f"{label}-edges")
        # Two numbers say whether the edges are what they were.
        state = tuple(current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
                      .first())
        if state == seen:
            break
        seen = state
    # Now every edge ties a node to its root.
    return (current.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionAll(current.select(F.col("b"), F.col("b")).distinct()))
