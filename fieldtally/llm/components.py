"""Connected components of an edge table, by alternating stars.

Nodes are longs. Every round hooks each node's larger neighbours to its smallest
one (large star), then each node and its smaller neighbours to the smallest
(small star); the edges end as one star per component. Only edges move, and the
minimum per node is combined before the shuffle. The minima are stored before
they are joined back, so a node with very many edges can be split by the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.basics import cut


def _state(edges: DataFrame) -> tuple:
    mark = F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mark)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("n"), F.least("u", "m").alias("m")
    )
    larger = both.where("v > u")
    joined = larger.join(cut(least), F.col("u") == F.col("n"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """`edges` run from a node u to a smaller v."""
    least = cut(edges.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m")))
    joined = edges.join(least, F.col("u") == F.col("n"))
    hooked = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hooked.unionByName(least.select(F.col("n").alias("u"), F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (u, v); root is the smallest node."""
    down = edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    now = cut(down.distinct())
    before, state = None, _state(now)
    while state != before and state[0]:
        now = cut(_small_star(cut(_large_star(now))))
        before, state = state, _state(now)
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
