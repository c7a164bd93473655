"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lidarframe.llm.common import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (src, dst: long); component: its smallest node.

    Self-loops give a node of its own, repeated and reversed edges change nothing, an empty table
    gives an empty table; edges with a null end are left out. A hub's edges are never gathered: a
    round takes minima with partial aggregates and joins them back, which AQE splits under skew.
    """
    loops = edges.where("src = dst").select(F.col("src").alias("node"), F.col("src").alias("component"))
    current = materialise(
        edges.where("src <> dst")
        .select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
        .distinct(),
        "edges",
    )
    state = _state(current)
    while state[0]:
        current = materialise(_small_star(_large_star(current)), "edges")
        after = _state(current)
        if after == state:
            break
        state = after
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = stars.select(F.col("component").alias("node"), "component")
    return stars.unionByName(roots).unionByName(loops).groupBy("node").agg(F.min("component").alias("component"))


def _state(edges: DataFrame) -> tuple:
    """Number and order-free digest of the edges."""
    row = edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("digest")
    ).first()
    return row.n, row.digest


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.withColumnRenamed("m", "v")).distinct()
