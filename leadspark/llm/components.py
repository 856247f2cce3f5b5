"""Connected components of a graph of long ids, by alternating stars.

Each round points the larger neighbours of a node at its smallest one, then does the same
for its smaller neighbours. Rounds grow with the logarithm of the longest chain. Only
minima are kept for a node, so a hub with many neighbours is never gathered; joins go
through a form whose hot partitions Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadspark.llm.shared import Workspace
from leadspark.operators.joins import split_left_join


def _size(edges: DataFrame):
    mark = F.xxhash64("u", "v").cast("decimal(38,0)")
    return edges.agg(F.count("*"), F.sum(mark)).first()


def components(edges: DataFrame, work: Workspace) -> DataFrame:
    """(node, root) for every node of `edges` (u, v); root is the smallest id reachable."""
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = work.store(edges.where("u <> v").distinct(), "edges-0")
    size, turn = _size(edges), 0
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("_v"))
        least = least.select("u", F.least("u", "_v").alias("low"))
        large = split_left_join(both.where("v > u"), least, ["u"])
        large = large.select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = split_left_join(large, least, ["u"])
        small = small.select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v")
        small = small.unionByName(least.select("u", F.col("low").alias("v"))).distinct()
        new = work.store(small, f"edges-{turn + 1}")
        work.drop(f"edges-{turn}")
        turn += 1
        now = _size(new)
        if now == size:
            break
        edges, size = new, now
    roots = new.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return new.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
