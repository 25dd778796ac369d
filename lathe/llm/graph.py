"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import cut


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links(a, b)`` -> ``(id, component)``: the smallest id reachable, for every id with a link.

    Each round ties every node's larger neighbours to its smallest one (large
    star), then its smaller ones (small star), and writes the links to the
    shared folder. Rounds grow with the logarithm of the longest path. A node
    with very many links is pre-aggregated by ``min`` before the shuffle and
    then met by a join that Spark can split, so it never fills one task.
    """
    edges = cut(links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for _ in range(max_rounds):
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = cut(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = cut(small)
        sums = [x.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first() for x in (edges, small)]
        edges = small
        if sums[0] == sums[1]:
            low = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
            return low.union(edges.select("v", "v")).distinct()
    raise RuntimeError(f"links did not contract in {max_rounds} rounds")
