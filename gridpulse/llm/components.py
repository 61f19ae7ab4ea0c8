"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.stages import Shared


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]


def _least_neighbour(both: DataFrame) -> DataFrame:
    return both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))


def components(edges: DataFrame, shared: Shared) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): root is its component's least.

    Alternating stars: every node tells its larger neighbours, then its smaller
    ones, of the least node it knows, until each node is linked with its root
    alone. A node's neighbours are joined and aggregated, never gathered, so a
    node with very many of them needs no large task. Rounds are written out.
    """
    edges = shared.write(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    last = _fingerprint(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (
            both.join(_least_neighbour(both), "a")
            .filter("b > a")
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        large = shared.write(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array("a", "b")).alias("node"), "least")
            .filter("node <> least")
            .select(F.col("node").alias("a"), F.col("least").alias("b"))
            .distinct()
        )
        small = shared.write(small, "small-star")
        now = _fingerprint(small)
        shared.drop(edges)
        shared.drop(large)
        edges = small
        if now == last:
            break
        last = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
