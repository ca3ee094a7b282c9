"""Connected components by alternating large-star and small-star rounds.

Works on an edge table of any size: a round is a grouped minimum (partial
aggregation first) and an equi-join, whose hot keys adaptive execution can
split; no component and no adjacency list is ever gathered in one place, and
no side of a join is broadcast, as both grow with the edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textweir.llm.common import Scratch


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of every node of `edges` (a, b: bigint); root is the component's least node.

    Loops and repeated edges are allowed; null ends are ignored; no edges
    give no rows.
    """
    edges = edges.select("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = scratch.keep(edges, "edges-0")
    before, k = _state(edges), 0
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        k += 1
        edges = scratch.keep(small.where("a <> b").distinct(), f"edges-{k}")
        scratch.drop(f"edges-{k - 1}")
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
