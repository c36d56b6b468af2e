"""Connected components of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strata.llm.store import stored


def _state(edges: DataFrame) -> tuple:
    """Number and hash sums of the links: alike from round to round when nothing moves."""
    sums = [F.sum(F.xxhash64(F.lit(seed), "a", "b").cast("decimal(38,0)")) for seed in (1, 2)]
    return tuple(edges.agg(F.count(F.lit(1)), *sums).first())


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node`` and ``root``, the least node of its component, for all linked nodes.

    Each round hooks every node's neighbours to the least node among them and then to that
    node's own choice, so long chains shorten fast; it ends when no link changes.
    Link rows are stored between rounds, so a lost executor repeats one round at most.
    """
    a, b = F.col(left), F.col(right)
    edges = stored(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a != b").distinct(), "links")
    state = _state(edges)
    while True:
        # every node to the least node that it or a neighbour of it is linked to
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        starred = stored(large.where("a != b").unionByName(least.where("a != m").select("a", F.col("m").alias("b"))).distinct(), "links")
        least = starred.groupBy("a").agg(F.min("b").alias("m"))
        small = starred.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = stored(least.select("a", F.col("m").alias("b")).unionByName(small).distinct(), "links")
        before, state = state, _state(after)
        if state == before:
            return after.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                after.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        edges = after
