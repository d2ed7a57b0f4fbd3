"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import materialise, prepare


def _mins(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _mins(both).select("u", F.least("u", "m").alias("m"))
    out = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.filter("u <> v")


def _small(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them; here v < u in every row."""
    least = _mins(edges)
    out = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return out.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of ``a, b``: component is the smallest node that links reach.

    Each round is two grouped minima and joins on the links, which turn into stars in a few rounds; links are written
    between rounds, so a lost executor costs a round at most. Self links and repeated links are allowed.
    """
    prepare(links.sparkSession)
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges = materialise(edges, "links")
    before = None
    for _ in range(rounds):
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        edges = materialise(_small(materialise(_large(edges), "links")), "links")
    else:
        raise RuntimeError("components did not settle")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select("component", "component").distinct().toDF("node", "component"))
