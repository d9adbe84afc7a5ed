"""Connected components of a graph that may have vertices with very many links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm import shared


def _stars(links: DataFrame) -> DataFrame:
    """Link each vertex's larger neighbours, then its smaller ones, to the least it sees."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()
    lowest = large.groupBy("b").agg(F.min("a").alias("m"))
    small = large.join(lowest, "b")
    return (
        small.where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        .union(lowest.select(F.col("m").alias("a"), "b"))
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """``node, root``: the least vertex that each vertex with a link is connected with.

    ``links`` has columns ``a, b``.  Rounds of large and small stars are written
    tables; they end when the links no longer change.  Minima are aggregated
    before they move, so a vertex with a third of the links is no burden.
    """
    ordered = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    now = shared.written(ordered.distinct(), "links")
    seen = None
    while True:
        mark = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        state = now.agg(F.count(F.lit(1)), mark).first()
        if state == seen or not state[0]:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
                now.select(F.col("a").alias("node"), F.col("a").alias("root"))
            ).distinct()
        seen = state
        now = shared.written(_stars(now), "links")
