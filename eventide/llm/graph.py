"""Connected components of a link table, by alternating large-star and small-star steps.

Each step is one aggregate (minimum neighbour, combined map-side) and one equality
join, which adaptive execution splits where a node has very many links.  Steps are
cut by tables in the shared folder; the number of steps grows with the logarithm of
the longest chain.  Nothing but a count and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.base import materialize


def _hook(links: DataFrame) -> DataFrame:
    """links (u, v): every v with the smallest of u and its neighbours."""
    least = links.groupBy("u").agg(F.min("v").alias("_m")).select(F.col("u").alias("_u"), F.least("u", "_m").alias("m"))
    return links.join(least, F.col("u") == F.col("_u")).select("u", "v", "m")


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has a link to another; root is the smallest node it reaches."""
    now = materialize(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hook(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = materialize(large)
        small = _hook(large)
        now = materialize(small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                          .unionByName(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
