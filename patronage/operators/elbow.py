"""Read a cost curve: reductions, the elbow and the cluster count it suggests.

A curve has one row per k, at most a few dozen, so its windows need no partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

def reductions(curve: DataFrame) -> DataFrame:
    """Per cent by which each k lowers the cost of the one before; 0 for the first."""
    before = F.lag("WSSSE").over(Window.orderBy("k"))
    change = F.try_divide(F.col("WSSSE"), before) - 1
    return curve.select(
        "k", "WSSSE", F.round(F.coalesce(change * -100, F.lit(0.0)), 2).alias("Reduction")
    )


def elbow_ratios(curve: DataFrame) -> DataFrame:
    """How much steeper the curve is before each inner k than after it.

    The ratio is null where the curve is flat after k.
    """
    by_k = Window.orderBy("k")
    before, after = F.lag("WSSSE").over(by_k), F.lead("WSSSE").over(by_k)
    steps = curve.select(
        "k", (F.col("WSSSE") - before).alias("before"), (after - F.col("WSSSE")).alias("after")
    )
    return steps.filter("before IS NOT NULL AND after IS NOT NULL").select(
        "k", F.try_divide("before", "after").alias("ratio")
    )


def elbow_pick(curve: DataFrame) -> DataFrame:
    """The k with the largest ratio, the smallest such k on ties; no row below three points."""
    return (
        elbow_ratios(curve)
        .filter("ratio IS NOT NULL")
        .orderBy(F.desc("ratio"), "k")
        .limit(1)
        .select(F.col("k").alias("optimal_k"))
    )
