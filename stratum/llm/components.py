"""Connected components of a table of links, by alternating star contraction.

Each round points every neighbour of a node at the smallest id among them. Minima are aggregated
before the shuffle and joined back, so a hub with a third of all links is no single task's group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import settle


def _smallest(pairs: DataFrame) -> DataFrame:
    """Pairs (u, v) with the smallest of u and all its v as m."""
    low = pairs.groupBy("u").agg(F.min("v").alias("low"))
    low = low.select(F.col("u").alias("w"), F.least("u", "low").alias("m"))
    return pairs.join(low, F.col("u") == F.col("w")).select("u", "v", "m")


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component) for every id of ``links`` (columns a, b); component is the smallest id.

    Links are undirected; loops and repeated links do no harm, null ends are left out. An empty
    table gives an empty one. Raises if the rounds do not suffice, rather than return a part.
    """
    edges = (
        links.filter("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    edges = settle(edges, "edges")
    state = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Larger neighbours of u move to the smallest one around u.
        large = _smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # Then u and its smaller neighbours move to the smallest of these.
        small = _smallest(large)
        moved = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))
        )
        edges = settle(moved.filter("u <> v").distinct(), "edges")
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == state:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            )
        state = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
