"""Connected components of a graph held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, shuffled, written


SALTS, MOST_BUSY = 16, 100_000


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _with_least(edges: DataFrame, least: DataFrame, total: int) -> DataFrame:
    """edges (a, b) with the m of their a. Busy nodes, of which there are MOST_BUSY at most, are broadcast, and salted."""
    busy = F.broadcast(edges.groupBy("a").agg(F.count("*").alias("n")).where(F.col("n") > max(64, 2 * total // MOST_BUSY)).select("a", F.lit(SALTS).alias("parts")))
    dealt = edges.join(busy, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), F.coalesce("parts", F.lit(1))).cast("int").alias("salt"))
    copies = least.join(busy, "a", "left").select("a", "m", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("salt"))
    return dealt.join(shuffled(copies), ["a", "salt"]).drop("salt")


def connected_components(links: DataFrame) -> DataFrame:
    """links: a, b (longs; either order, repeats allowed). Returns node, root (smallest node of its component) for nodes that have a link and aren't roots.

    Alternates large-star and small-star steps, which take a number of rounds
    that grows with the logarithm of the graph. Each step groups and joins
    by node; the links of a node that has many are dealt over SALTS tasks. Each
    round's table ends the lineage.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    was = _state(edges)
    while was[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = _with_least(both, least, was[0]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = _with_least(large, low, was[0]).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        new = written(small, "links")
        now = _state(new)
        drop_written(edges)
        edges = new
        if now == was:
            break
        was = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
