"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import Scratch


def _lowest(edges: DataFrame) -> DataFrame:
    """The smaller of each node and its least neighbour."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def large_star(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Every node's larger neighbours point at the least node of its neighbourhood."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = scratch.write(_lowest(both), f"{name}_low")  # joined as a table, so that a hot node's rows can be split
    return both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def small_star(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Every node and its smaller neighbours point at the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = scratch.write(_lowest(down), f"{name}_low")
    moved = down.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(lowest.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, scratch: Scratch, label: str = "cc") -> DataFrame:
    """(node, component): each node of ``edges`` (u, v) and the least node it reaches.

    Each round is two joins on written tables; rounds are about the logarithm of the
    largest component's size. Loops and repeated edges are allowed.
    """
    last, k = None, 0
    now = scratch.write(edges.select("u", "v").where("u <> v").distinct(), f"{label}_0")
    nodes = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    while True:
        k += 1
        large = scratch.write(large_star(now, scratch, f"{label}_{k}l"), f"{label}_{k}l")
        new = scratch.write(small_star(large, scratch, f"{label}_{k}s"), f"{label}_{k}s")
        for name in (f"{label}_{k - 1}", f"{label}_{k - 1}s", f"{label}_{k}l", f"{label}_{k}l_low", f"{label}_{k}s_low"):
            scratch.drop(name)
        sign = new.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        sign = (sign["n"], sign["h"])
        if sign == last:
            roots = new.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return nodes.join(roots, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
        last, now = sign, new
