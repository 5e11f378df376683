"""Summaries of the customer table, whole and per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage import schema as S


def mean(name: str) -> Column:
    """Mean of a measure; money is averaged exactly, so its rounding ignores row order."""
    if name != "Monetary":
        return F.avg(name)
    return F.avg(F.col(name).cast(S.MONEY)).cast("double")


def scored(labelled: DataFrame) -> DataFrame:
    """The columns of the customer export."""
    return labelled.select(*S.SCORED_COLUMNS)


def customer_kpis(rfm: DataFrame) -> DataFrame:
    """Customers and their mean measures, as one row."""
    return rfm.agg(
        F.count("*").alias("customers"),
        *(mean(m).alias(f"{m}_mean") for m in S.MEASURES),
    )


def profile(customers: DataFrame, key: str = "prediction") -> DataFrame:
    """Statistics per group, rounded half-up to two places.

    The sample standard deviation of a single customer is null. Rows come in the order of `key`.
    """
    statistics = {"mean": mean, "std": F.stddev_samp, "min": F.min, "max": F.max}
    return customers.groupBy(key).agg(
        F.count("CustomerID").alias("CustomerID_count"),
        *(
            F.round(function(m), 2).alias(f"{m}_{name}")
            for m in S.MEASURES
            for name, function in statistics.items()
        ),
        *(
            F.round(F.avg(m), 2).alias(f"{m}_mean")
            for m in ("TotalTransactions", "AvgTransactionValue", "RFM_Score")
        ),
    ).orderBy(key)


def group_sizes(customers: DataFrame, key: str = "prediction") -> DataFrame:
    """Customers per group, ordered by group."""
    return customers.groupBy(key).agg(F.count("*").alias("customers")).orderBy(key)


def group_means(customers: DataFrame, key: str = "prediction") -> DataFrame:
    """Mean measures per group, ordered by group."""
    means = (mean(m).alias(f"{m}_mean") for m in S.MEASURES)
    return customers.groupBy(key).agg(*means).orderBy(key)
