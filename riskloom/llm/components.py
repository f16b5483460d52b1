"""Connected components by alternating large-star and small-star rounds (joins and aggregates only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Scratch


def _towards(edges: DataFrame, neighbours: DataFrame) -> DataFrame:
    """Each (u, v) of ``neighbours`` with the least of u and its neighbours in ``edges`` (u, v)."""
    least = edges.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
    return neighbours.join(least, "u")


def connected_components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b longs); component is the smallest node.

    The edge list is a written table in every round, of which the last, ``name``-<round>, stays; its
    number of rows never grows, and the rounds needed grow with the logarithm of the longest path.
    """
    def tidy(df: DataFrame, step: int) -> DataFrame:
        pair = df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct()
        return scratch.table(pair, f"{name}-{step}")

    def digest(df: DataFrame):
        row = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        return row["n"], row["s"]

    current, step = tidy(edges.select(F.col("a").alias("u"), F.col("b").alias("v")), 0), 0
    before = digest(current)
    while before[0]:
        step += 1
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _towards(both, both.filter("v > u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        small = _towards(large, large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v")))
        current = tidy(small, step)
        now = digest(current)
        scratch.remove(f"{name}-{step - 1}")
        if now == before:
            break
        before = now
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
