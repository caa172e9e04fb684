"""Connected components of a graph given by its links, by alternating star contractions.

A large star hangs every larger neighbour of a node on the smallest node around it, a small
star every smaller one; both keep the components and end in one star for each, whose centre is
its smallest node. Rounds grow with the logarithm of the longest path. Each round is two
aggregations with map-side combining and two joins of links with one row per node, which
adaptive execution can split at a hot node; no node's links meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roundhaul.llm.common import Scratch


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("centre"))
    hung = both.where("b > a").join(least, "a")
    return hung.select(F.col("b").alias("a"), F.col("centre").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("centre"))
    hung = links.join(least, "a").where("b <> centre").select(F.col("b").alias("a"), F.col("centre").alias("b"))
    return hung.unionByName(least.select("a", F.col("centre").alias("b"))).distinct()


def components(links: DataFrame, scratch: Scratch, label: str = "links") -> DataFrame:
    """(node, component) for every node with a link; links have integer columns a and b.

    Links to itself and repeated links change nothing; links with a NULL end are left out. No
    links give no rows.
    """
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = scratch.write(ordered.distinct(), f"{label}-0")
    seen, turn = None, 0
    while True:
        state = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state["n"] == 0 or state == seen:
            break
        seen, turn = state, turn + 1
        current = scratch.write(_small_star(_large_star(current)), f"{label}-{turn}")
        scratch.drop(f"{label}-{turn - 1}")
    centres = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(centres)
