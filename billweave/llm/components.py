"""Connected components of links by alternating stars; labels are the smallest ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billweave.llm.common import stored


def toward_least(pairs: DataFrame, every: bool) -> DataFrame:
    """One star step on pairs (a, b): each neighbour of a vertex is joined to the least one around that vertex.

    ``every`` takes all neighbours and keeps the larger ones (large star), else the smaller ones only (small star).
    The least neighbour is an aggregate with partial sums, and pairs are joined to it, so a vertex with many links is
    split over tasks.
    """
    both = pairs.select("a", "b")
    both = both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))) if every else both.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    joined = both.join(least, "a")
    if every:
        moved = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            joined.select("a", F.col("low").alias("b"))
        )
    return moved.filter(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(a, b) for each vertex ``a`` of the links (a, b) that isn't the least of its component, with that least ``b``.

    Rounds go on until nothing changes; their number grows with the logarithm of the number of vertices. Each round
    is written to the shared folder.
    """
    state, before = stored(links.select("a", "b").filter("a != b").distinct(), "links"), None
    while True:
        state = stored(toward_least(toward_least(state, True), False), "stars")
        mark = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            return state
        before = mark
