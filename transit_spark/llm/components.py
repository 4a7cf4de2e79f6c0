"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transit_spark.llm.common import Scratch

MAX_ROUNDS = 60


def _least(pairs: DataFrame) -> DataFrame:
    """For each ``u`` the smallest node among itself and its ``v``."""
    return pairs.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))


def components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) for every end of ``edges`` (``a``, ``b``, any order).

    Each step takes one minimum per node, combined on the map side, and one equi-join that Spark
    splits when a node is hot. Rounds are written to the shared folder; their number grows with the
    logarithm of the longest chain. Nodes without an edge are absent; loops and repeats do no harm.
    """
    low = edges.where("a <> b").select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u"))
    current = scratch.stage(low.distinct(), f"{name}-0")
    before = None
    for turn in range(1, MAX_ROUNDS + 1):
        both = current.select("u", "v").union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).where("u <> v").distinct()
        large = scratch.stage(large, f"{name}-{turn}-large")
        least = _least(large)
        small = (
            large.join(least, "u").where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
            .union(least.select("u", F.col("least").alias("v")))
            .distinct()
        )
        small = scratch.stage(small, f"{name}-{turn}")
        state = small.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        scratch.drop(f"{name}-{turn}-large")
        if turn > 1:
            scratch.drop(f"{name}-{turn - 1}")
        current = small
        if state == before:
            roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
        before = state
    raise RuntimeError("the components did not settle")
