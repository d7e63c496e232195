"""Connected components of a large graph by alternating large-star and small-star steps (Kiveris et al., 2014).

Each step is one minimum by node (summed map-side) and one join back; a node with very many links costs its rows
in a join that the adaptive plan splits, never a list in one task. Each step's edges are written to the shared
folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeweave.llm.common import stored


def _with_least(edges: DataFrame) -> DataFrame:
    """edges (u, v) with m, the least of u and its neighbours."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return edges.join(least, "u")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for the nodes of edges (a, b); root is the least node that can be reached. Loops and repeats may occur."""
    links = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    for _ in range(most_rounds):
        both = links.union(links.select("v", "u"))
        large = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = _with_least(large)
        small = least.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        after = stored(small, "links")
        # finished when every node has one link, to a node that has none of its own
        if after.groupBy("u").count().filter("count > 1").limit(1).count() == 0 and after.alias("x").join(after.alias("y"), F.col("x.v") == F.col("y.u"), "left_semi").limit(1).count() == 0:
            return after.select(F.col("u").alias("node"), F.col("v").alias("root"))
        links = after
    raise RuntimeError("the components have not settled")
