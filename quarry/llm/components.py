"""Connected components by alternating large-star and small-star rounds.

Each round replaces edges by edges to the smallest neighbour (Kiveris et al.,
2014); the edge table shrinks to one star per component.  Only joins and
``min`` aggregations: no neighbour list is ever collected, so a hub costs its
edges and nothing more.  Every round is checkpointed, so a lost executor
repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import settled


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    return (both.filter("v > u").join(low, F.col("u") == F.col("k"))
                .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v")
    low = down.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
    moved = down.join(low, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select(F.col("k").alias("u"), F.col("m").alias("v"))).filter("u != v").distinct()


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v") % 1_000_003), F.lit(0))).first())


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an edge; component = smallest node.

    Self edges and repeated edges are allowed; an empty table gives no rows.
    """
    e = settled(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u != v").distinct())
    before = _state(e)
    for _ in range(max_rounds):
        if not before[0]:
            break
        e = settled(_small_star(_large_star(e)))
        now = _state(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = stars.select(F.col("component").alias("node"), "component").distinct()
    return stars.union(roots)
