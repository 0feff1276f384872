"""Connected components of a graph given as edges, by alternating large-star and small-star steps.

Every step is a groupBy and a join; edges are written to the shared checkpoint folder after each
round, so the lineage stays short and a lost executor costs one round's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeworks.llm.common import join_groups, written

ROUNDS = 60


def _with_least(edges: DataFrame, total: int) -> DataFrame:
    """(u, v) of every edge with the least v of its u; a u with very many edges does not shuffle."""
    least = written(edges.groupBy("u").agg(F.min("v").alias("least"), F.count("*").alias("degree")), "least")
    return join_groups(edges, least, "u", "degree", total)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge and is not its component's least node.

    ``edges`` has long columns u and v; direction, repeats and loops do not matter. No node and no
    edge is ever collected.
    """
    u, v = F.col("u"), F.col("v")
    low_first = [F.greatest(u, v).alias("u"), F.least(u, v).alias("v")]
    held = written(edges.filter(u != v).select(*low_first).distinct(), "edges")
    mark = None
    for _ in range(ROUNDS):
        size, *seen = held.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (size, seen) == mark or not size:
            return held.select(u.alias("node"), v.alias("root"))
        mark = (size, seen)
        both = held.unionByName(held.select(v.alias("u"), u.alias("v")))
        large = _with_least(both, 2 * size).filter(v > u)
        large = large.select(v.alias("u"), F.least(u, "least").alias("v")).distinct()
        small = _with_least(large, size)
        hooked = F.array(F.struct(v.alias("u"), F.col("least").alias("v")), F.struct(u, F.col("least").alias("v")))
        held = written(small.select(F.inline(hooked)).filter(u != v).distinct(), "edges")
    raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
