"""Connected components of an edge list, by alternating large and small stars.

Every step is a partial aggregation and an equi-join, so a node with very many edges is combined on
the map side and split by adaptive execution; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eodlake.llm.common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected edges (u, v); root is the least node reachable.

    Edges with a null end and loops are left out; repeated edges count once. No edges give no rows.
    """
    edges = edges.select("u", "v").dropna().where("u != v")
    edges = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = _print(edges)
    while before[0]:
        edges = cut(_small_star(_large_star(edges)))
        after = _print(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select("v", "v").distinct()
    )
