"""Connected components of an edge table, by alternating large-star and small-star steps.

Defined cases: an edge of a node with itself, or with a null end, is none; repeated edges and both directions of one count
once; other columns are not read; an empty table gives an empty table. Only numbers are read, no texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.common import discard, written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (u, v), u > v. Large: each node links its larger neighbours to its least one; small: it links its smaller ones."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        return both.where("v > u").join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u")
    return moved.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u != v").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): for each node of edges (a, b), numbers, the least node that it reaches. Nodes without an edge aren't in it."""
    now = written(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    mark = None
    while True:
        # small-star lets each node keep its least neighbour; the sum of hashes tells whether anything moved
        after = written(_stars(_stars(now, True), False), name)
        new = tuple(after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        discard(now)
        now = after
        if new == mark:
            break
        mark = new
    # every node has one edge, to its component, which has none
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
