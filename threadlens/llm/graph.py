"""Connected components of a large sparse graph, as joins and aggregations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``links`` (a, b): root is the smallest node reachable.

    Large-star and small-star rounds: each node first hands its larger neighbours, then its smaller ones, to the
    smallest node near it, until only stars are left (a number of rounds that grows with the logarithm of the
    longest path).  The minimum of a neighbourhood is combined before the exchange, and both sides of the joins
    that hand it out are read from tables, so that a hub's rows can be split.  Loops, repeated links and links
    with a null end are allowed and change nothing.
    """
    edges = links.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct()
    edges, last = staged(edges, "links"), None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = staged(both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a", "least(a, m) AS m"), "near")
        large = both.join(near, "a").where("b > a").selectExpr("b AS a", "m AS b").distinct()
        large = staged(large, "large")
        near = staged(large.groupBy("a").agg(F.min("b").alias("m")), "near")
        small = large.join(near, "a").selectExpr("inline(array(struct(a AS a, m AS b), struct(b AS a, m AS b)))")
        edges = staged(small.where("a <> b").distinct(), "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == last:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        last = state
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
