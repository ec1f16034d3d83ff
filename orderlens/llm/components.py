"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.operators.durable import drop, store


def _least_neighbour(links: DataFrame) -> DataFrame:
    """(u, low): the least v of each u, map-side combined.

    The second grouping column keeps this aggregate's partitioning from being reused
    by the join that follows: adaptive execution splits a hot u only if both sides of
    the join come straight from a shuffle made for it.
    """
    part = F.xxhash64("u").alias("_part")
    return links.groupBy("u", part).agg(F.min("v").alias("low")).drop("_part")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (two columns of one ordered type).

    `root` is the least node that can be reached.  Links may repeat, run in either
    direction or lead from a node to itself; those with a null are ignored.  An
    empty table has no nodes.

    Alternates large-star and small-star steps until nothing changes; the number of
    rounds grows with the logarithm of the longest path.  No step gathers a node's
    neighbours: each takes a minimum per node and joins it back.  Every round is a
    stored table, and the one before it is dropped.
    """
    spark = links.sparkSession
    a, b = (F.col(f"`{c}`") for c in links.columns)
    named = links.select(a.alias("u"), b.alias("v")).dropna()
    alone = named.filter("u = v").select(F.col("u").alias("node"), F.col("v").alias("root"))
    pairs = named.filter("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    current, path = store(pairs.distinct())
    before = None
    while True:
        sign = current.agg(
            F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(xxhash64(v, u) % 1000003)")
        ).first()
        if tuple(sign) == before or sign[0] == 0:
            break
        before = tuple(sign)
        following, new_path = store(_small_star(_large_star(current)))
        drop(spark, path)
        current, path = following, new_path
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root"))
    reached = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    known = reached.unionByName(roots.distinct())
    lonely = alone.distinct().join(known, "node", "left_anti")
    return known.unionByName(lonely)


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of u to the least of u and its neighbours."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _least_neighbour(both).withColumn("low", F.least("u", "low"))
    larger = both.filter("v > u").join(low, "u")
    return larger.select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link u and its smaller neighbours to the least of them."""
    low = _least_neighbour(links)
    smaller = links.join(low, "u").filter("v != low").select(
        F.col("v").alias("u"), F.col("low").alias("v")
    )
    own = low.select("u", F.col("low").alias("v"))
    return smaller.unionByName(own).distinct()
