"""Connected components of a table of links, by joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dirsync.operators.lookups import lookup
from dirsync.session import materialise


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: the smallest node that each linked node reaches.

    Rounds of large and small stars: every node's larger neighbours, then its
    smaller ones, are hung on the smallest node it knows.  Each round keeps the
    components, and the number of rounds grows with the logarithm of the longest
    chain.  A round is written to the shared folder, so that a lost executor
    costs one round; minima are formed before the shuffle and looked up from the
    links, whose side of that join can be split, so a node with very many links is
    never gathered.  Links with a null end or to the node itself are left out.
    """
    x, y = F.col(a), F.col(b)
    edges = links.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct()
    edges = materialise(edges, "links")
    was = _signature(edges)
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # larger neighbours of u hang on m(u); each edge (u, v) with u > v is a larger neighbour of v
        large = _found(edges, least, "v").select(F.col("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        own = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _found(large, own, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        after = materialise(small.where("u != v").distinct(), "links")
        now = _signature(after)
        if now == was:
            break
        edges, was = after, now
    found = after.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.unionByName(after.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _found(edges: DataFrame, minima: DataFrame, end: str) -> DataFrame:
    """Links with the minimum of their one end, which may be the same for very many."""
    return lookup(edges, minima.withColumnRenamed("u", "__node"), F.col(end).cast("string"), "__node", pos=end)


def _signature(edges: DataFrame) -> tuple:
    """Two tables of distinct edges with the same signature are taken to be equal."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 31)))).first())
