"""Connected components of links by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.common import stored


def _min_neighbour(arcs: DataFrame) -> DataFrame:
    return arcs.groupBy("a").agg(F.min("b").alias("m"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable by links, for every node that has a link.

    Large-star hands a node's larger neighbours to its smallest one, small-star its smaller ones; the steps repeat
    until every link leads straight to the smallest node. Each step is a partial minimum and an equi-join, so a node
    with a third of all links is spread; nothing of a component is collected. Each round is written and reread.
    Nodes may be of any type with an order. Empty input gives an empty table; self-links and null ends are ignored; repeated links count once.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    edges = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        mark = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _min_neighbour(both).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").where("b <> m").select("m", "b")
        # every arc now leads from the larger to the smaller end
        down = large.select(F.greatest("m", "b").alias("a"), F.least("m", "b").alias("b")).distinct()
        least = _min_neighbour(down)
        small = down.join(least, "a").select("m", "a", "b").select(
            F.explode(F.array(F.struct(F.col("m"), F.col("a").alias("x")), F.struct("m", F.col("b").alias("x")))).alias("s"))
        edges = stored(small.select(F.col("s.m").alias("a"), F.col("s.x").alias("b")).where("a <> b").distinct(), "star")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
