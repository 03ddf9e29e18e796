"""Connected components of an edge table by alternating star contractions.

Published scheme (large-star / small-star, Kiveris et al. 2014): every round
hooks the larger neighbours of a node, then the smaller ones, to the smallest
node known next to it.  Rounds are joins and partial minima, so no component
is ever gathered in one task; each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored


def _mark(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))  # edges point from the larger node to the smaller
    moved = e.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return low.select("u", F.col("m").alias("v")).unionByName(moved)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(u, v)`` -> ``(u, v)``: each node that is not the smallest of its
    component, with that smallest node.  Raises if ``max_rounds`` do not suffice."""
    e = (edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e = stored(e, "edges")
    mark = _mark(e)
    for _ in range(max_rounds):
        if not mark[0]:
            return e
        e = stored(_small_star(_large_star(e).distinct()).distinct(), "stars")
        now = _mark(e)
        if now == mark:
            return e
        mark = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
