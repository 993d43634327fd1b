"""Connected components of an edge table by alternating star contractions, each round a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.session import stored


def _least(pairs: DataFrame) -> DataFrame:
    """u, v, and the least of u's neighbours and itself; the pairs are directed from u."""
    least = pairs.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m"))
    return pairs.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """node, root: the least node reachable, for every node of ``edges`` (columns ``u`` and ``v``; direction is ignored).

    Large stars hang every greater neighbour on the least node seen, small stars every smaller one, until nothing moves.
    A hub's neighbours are never gathered in a task; each round is a grouped minimum and a join that can be split.
    """
    edges = edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    now = stored(edges, "components-edges")
    while True:
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(large, "components-large")  # u > v
        small = _least(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        after = stored(
            small.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "components-round"
        )
        if now.count() == after.count() and now.exceptAll(after).isEmpty():
            break
        now = after
    hung = now.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return hung.unionByName(now.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
