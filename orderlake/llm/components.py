"""Connected components of an edge table by alternating star rounds.

Each round turns every node's edges towards the least node it sees: first from its larger
neighbours (large star), then from its smaller ones (small star). Groups are only ever reduced to
their minimum, which Spark computes map-side first, so a hub costs a partial row a task; the hub's
edges meet its one minimum in a join whose sides are both fresh shuffles, which AQE can split.
Every round is settled in the shared folder. Nothing but a row count and a checksum reaches the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def _least(edges: DataFrame) -> DataFrame:
    return settle(edges.groupBy("u").agg(F.min("v").alias("m")), "cc-min")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges``; a component is named by its least node.

    Edges with a null end are ignored; an edge from a node to itself only names the node.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    stars = settle(pairs.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .distinct(), "cc-edges")
    seen = None
    while True:
        r = stars.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if r["n"] == 0 or (r["n"], r["h"]) == seen:
            break
        seen = (r["n"], r["h"])
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = _least(both).select("u", F.least("u", "m").alias("m"))
        large = settle(both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .distinct(), "cc-large")
        lowest = _least(large)
        stars = settle(large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "cc-edges")
    return nodes.join(stars.withColumnRenamed("u", "node"), "node", "left").select(
        "node", F.coalesce("v", "node").alias("component"))
