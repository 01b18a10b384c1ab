"""Connected components of a table of links, by alternating large and small stars.

Each round is a few shuffled joins and aggregates over the links and is written to the shared
folder; the links never come to the driver. Hub vertices are rows of a join, which adaptive
execution splits, and minima are pre-aggregated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtlens.llm.common import discard, store


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex is linked to the least of its neighbourhood."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
    return (
        both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    ).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every vertex and its smaller neighbours are linked to the least of them; here b < a."""
    least = links.groupBy("a").agg(F.min("b").alias("root"))
    others = links.join(least, "a").filter("b <> root")
    return (
        others.select(F.col("b").alias("a"), F.col("root").alias("b"))
        .unionByName(least.select("a", F.col("root").alias("b")))
        .distinct()
    )


def connected_components(links: DataFrame) -> DataFrame:
    """(vertex, root): the least vertex of each linked vertex's component, except roots themselves.

    ``links`` has columns a and b of one ordered type; loops and repeated links do no harm. An
    empty table has an empty result.
    """
    current = store(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a > b")
        .distinct(),
        "links",
    )
    while True:
        after = store(_small_star(_large_star(current)), "links")
        # Stars are final: one root for each vertex, and no root below another.
        chained = after.select(F.col("b").alias("a")).distinct().join(after, "a", "left_semi")
        split = after.groupBy("a").count().filter("count > 1")
        done = chained.isEmpty() and split.isEmpty()
        discard(current)
        current = after
        if done:
            return current.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
