"""Connected components of an edge table, by rounds of minimum labels in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import cut, discard


def components(edges: DataFrame) -> DataFrame:
    """``(a long, b long)`` edges to ``(node, label)``: label is the smallest node reachable.

    Each round replaces edges by stars: every node's larger neighbours are tied
    to its smallest one, then its smaller neighbours to the smallest of all, so
    that paths shrink by a factor in each round (the alternation of large and
    small stars). The edges stay distributed; only a change count reaches the
    driver. A node with very many neighbours is summed on the map side for its
    minimum, and the join that uses it splits by the edge side.
    """
    edges = cut(edges.where("a <> b").select("a", "b").distinct(), "edges")
    before = _sum(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = cut(large, "edges")  # from larger to smaller node
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        last, edges = edges, cut(small.select("e.*").where("a <> b").distinct(), "edges")
        discard(last, large)
        now = _sum(edges)
        if now == before:
            break
        before = now
    # every edge now leads from a node to its component's smallest one
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots).distinct()


def _sum(edges: DataFrame) -> tuple:
    """What tells two edge tables apart: their number and the sums of two hashes."""
    h = lambda salt: F.sum(F.xxhash64("a", "b", F.lit(salt)).cast("decimal(20,0)"))
    return tuple(edges.agg(F.count("*"), h(1), h(2)).first())
