"""Connected components of an undirected graph by alternating star contractions, all as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import freeze


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))))).select("col.*")


def _star(rows: DataFrame, keep: str) -> DataFrame:
    """Link the neighbours v of u that keep selects, and for a small star u itself, to the least of u and its neighbours."""
    # stored: a join straight on an aggregate shares its shuffle, and Spark could not split a hub that very many rows link to
    least = freeze(rows.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m")))
    linked = rows.join(least, F.col("u") == F.col("c")).select("u", "v", "m")
    if keep == "large":
        ends = linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        ends = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select(F.col("c").alias("u"), F.col("m").alias("v"))
        )
    return ends.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and root, the least node of its component, for every end of the edges (u, v) that isn't its own root.

    Each round is written to the shared folder. The work ends once a round leaves the edges as they are, which then
    are stars around the roots; the number of rounds grows with the logarithm of the longest chain.
    """
    mark = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    edges = freeze(edges.where("u <> v").select("u", "v"))
    seen = None
    while True:
        large = _star(_both(edges), "large")
        low = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        edges = freeze(_star(low, "small"))
        now = mark(edges)
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
