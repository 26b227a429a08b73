"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiq.llm.common import discard, materialize


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``edges`` (a, b: any two equal orderable types) to (node, component): the least node it reaches.

    Every round points all larger neighbours of a node at its least neighbour, then all smaller ones; the
    edges end as stars. A round is two aggregates with map-side minima and two joins against one row per node,
    so a node with very many edges is spread by the skew join. Each round is written to the shared folder and the one before deleted.
    Nodes without an edge don't appear. An empty table gives an empty table.
    """
    stars = materialize(_oriented(edges.select("a", "b")), label)
    state = _state(stars)
    while True:
        before, stars = stars, materialize(_small_star(_large_star(stars)), label)
        discard(before)
        now = _state(stars)
        if now == state:
            break
        state = now
    centres = stars.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(centres)


def _oriented(edges: DataFrame) -> DataFrame:
    return (edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.withColumnRenamed("m", "b")).distinct()
