"""Connected components of an edge table, by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.staging import stage


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node, component (its least reachable node) for every node that has an edge (a, b).

    Large-star and small-star steps in turn: each node's neighbours are linked to the least of
    them, first the larger ones, then the smaller ones. Rows never outnumber the edges much, every
    round is written to the shared folder, and the number of rounds grows with the logarithm of
    the longest path. Least neighbours are found with partial aggregation. A node with very many
    neighbours is one key of two joins by sorting, which adaptive execution splits where it is large.
    """
    links = stage(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v"), name
    )
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.where("u <> v").join(small, "u")
        pairs = F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v"))
        )
        links = stage(joined.select(F.inline(pairs)).where("u <> v").distinct(), name)
        # a forest of stars is the end: every node has one parent, and no parent has one
        ends = links.select(
            F.inline(F.array(
                F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")),
            ))
        ).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if not ends.agg(F.count_if(F.expr("up > 1 or (up = 1 and down = 1)"))).first()[0]:
            break
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stage(links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots), name)
