"""Connected components of links, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tideline.llm.frames import stored


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; the root is the smallest node that can be reached.

    Alternates two rewritings until nothing changes: every node hands its
    smallest neighbour to its larger neighbours, then to its smaller ones.
    The number of rounds grows with the logarithm of the longest chain, and a
    node with many neighbours is combined before it is shuffled.  Each round
    is written to the shared folder.

    Links of a node to itself and repeated links add nothing; a link with a
    null end must not occur; no links give no nodes.
    """
    edges = stored(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).union(
                edges.select("b", "b").distinct()
            )
        before = state
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        large = (
            both.join(least, F.col("a") == F.col("k")).where("b > a AND b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        least = large.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("m"))
        small = large.join(least, F.col("a") == F.col("k"))
        edges = stored(
            small.select("a", F.col("m").alias("b")).union(small.where("b <> m").select("b", "m")).distinct(), "links"
        )
