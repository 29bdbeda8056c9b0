"""Connected components by rounds of small joins: every node ends with the smallest id it can reach."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meterlark.session import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of ``edges`` (a, b) that an edge leads to another; two longs without nulls.

    Alternates two steps (Kiveris et al., "Connected components in MapReduce and beyond", 2014): each node links its larger
    neighbours to its smallest neighbour, then its smaller ones. Both steps keep at most one edge per edge. A node's
    smallest neighbour is an aggregate that joins back, so a hub held by a third of the edges is summed before it is
    shuffled and its edges are split by adaptive execution, never gathered. Rounds grow with the logarithm of the
    longest path; each round is a written table.
    """
    now = stage(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "links")

    def towards_smallest(links: DataFrame, larger: bool) -> DataFrame:
        """``links`` (u, v): connect v to the smallest of u and its neighbours, for v > u (large star) or v <= u (small star)."""
        least = links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        joined = links.join(least, "u")
        return joined.filter("v > u" if larger else "v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))

    while True:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = towards_smallest(both, larger=True).distinct()
        # Every node u with its smaller neighbours, and u itself, so that u hangs on the smallest too.
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(least, "u").filter("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))
            .unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct()
        )
        following = stage(small, "links")
        # Settled when every edge leads from a smallest node straight to a member: no node is both, none hangs on two.
        hung = following.groupBy("b").agg(F.count(F.lit(1)).alias("n"))
        heads = following.select(F.col("a").alias("b")).distinct()
        # One number each: nodes hanging on two, and heads that hang themselves.
        twice = hung.filter("n > 1").limit(1).count()
        chained = 0 if twice else heads.join(hung, "b", "left_semi").limit(1).count()
        now = following
        if not twice and not chained:
            break
    return now.select(F.col("b").alias("id"), F.col("a").alias("component")).unionByName(
        now.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct())
