"""Connected components of a graph given by its edges, in Spark joins and partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.textkit import discard, stored, totals


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of every node that has an edge; comp is the smallest node it can reach.

    Large-star then small-star until nothing changes: each round links a node's neighbours to the smallest of them, so
    chains shorten by half and a hot node needs one partially aggregated minimum, never its list of neighbours. The
    edges are ``a`` and ``b`` (long). Each round is written to the shared folder; only its change count is collected.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    size = (F.lit(1).cast("long"), F.xxhash64("a", "b"))
    before = totals(edges, *size)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large.unionByName(edges.join(least, "a").select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        new = stored(small.where("a <> b").distinct(), "small")
        after = totals(new, *size)
        discard(large, edges)
        edges = new
        if before == after:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())
