"""Segment names for groups and customers, and what follows from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage import schema as S
from patronage.functions.scalars import (
    numbered_cluster,
    segment_description,
    segment_kind,
    segment_name,
)
from patronage.operators.profile import mean

# A short default per kind of segment; callers pass their own catalogue.
ACTIONS = {
    "VIP": (
        "Hold stock and service capacity back for these accounts",
        "Ask before the assortment changes what they would miss",
        "Raise an alert when an account is a week past its usual order date",
    ),
    "Loyal": (
        "Propose a standing order for the items bought most often",
        "Quote the next larger pack size with each reorder",
        "Review yearly terms with each account in person",
    ),
    "New": (
        "Check that the first delivery arrived complete",
        "Suggest what comparable accounts ordered second",
        "Open a credit line after the third paid invoice",
    ),
    "Inactive": (
        "Verify contact and delivery details",
        "Compare prices of the last order with current ones and send the difference",
        "Move to the low-cost contact list if two attempts stay unanswered",
    ),
    "Other": (
        "Handle small orders through self-service",
        "Look at margin per order before spending on contact",
        "Score again next quarter and act on a change of segment",
    ),
}


def name_groups(
    profile: DataFrame, key: str = "prediction", rules: S.SegmentRules = S.SegmentRules()
) -> DataFrame:
    """Name and describe each group of a profile by its rounded means."""
    name = segment_name(
        F.col("Recency_mean"),
        F.col("Frequency_mean"),
        F.col("Monetary_mean"),
        numbered_cluster(F.col(key)),
        rules,
    )
    named = profile.withColumn("Segment_Name", name)
    return named.withColumn("Description", segment_description(F.col("Segment_Name"), rules))


def name_customers(
    rfm: DataFrame, rules: S.SegmentRules = S.SegmentRules(), fallback: str = "Regular"
) -> DataFrame:
    """Apply the same ladder to each customer's own measures."""
    name = segment_name(
        F.col("Recency"), F.col("Frequency"), F.col("Monetary"), F.lit(fallback), rules
    )
    return rfm.withColumn("Segment", name)


def attach_segments(
    customers: DataFrame, named: DataFrame, key: str = "prediction"
) -> DataFrame:
    """Give each customer its group's segment, or a numbered cluster when there is none.

    `named` holds one row per group; staged, its size decides the join strategy. Columns keep
    their order.
    """
    names = named.select(key, F.col("Segment_Name").alias("Segment"))
    segment = F.coalesce("Segment", numbered_cluster(F.col(key))).alias("Segment")
    return customers.join(names, key, "left").select(*customers.columns, segment)


def actions(spark: SparkSession, catalogue: dict[str, tuple[str, ...]] = ACTIONS) -> DataFrame:
    """The action catalogue as rows (segment_kind, rank, action)."""
    rows = [
        (kind, rank, action)
        for kind, listed in catalogue.items()
        for rank, action in enumerate(listed, 1)
    ]
    return spark.createDataFrame(rows, "segment_kind string, rank int, action string")


def recommend(
    named: DataFrame, catalogue: dict[str, tuple[str, ...]] = ACTIONS
) -> DataFrame:
    """Numbered actions for each distinct segment name."""
    segments = (
        named.select("Segment_Name")
        .dropDuplicates(["Segment_Name"])
        .withColumn("segment_kind", segment_kind(F.col("Segment_Name")))
    )
    return (
        segments.join(actions(named.sparkSession, catalogue), "segment_kind")
        .select("Segment_Name", "rank", "action")
        .orderBy("Segment_Name", "rank")
    )


def customer_total(named: DataFrame) -> DataFrame:
    """Customers over all groups."""
    return named.agg(F.sum("CustomerID_count").alias("customers"))


def vip_count(named: DataFrame) -> DataFrame:
    """Customers in groups whose name contains VIP."""
    vip = F.when(F.col("Segment_Name").contains("VIP"), F.col("CustomerID_count"))
    return named.agg(F.coalesce(F.sum(vip), F.lit(0)).alias("vip_customers"))


def revenue(customers: DataFrame, key: str = "prediction") -> DataFrame:
    """Revenue per group, exact and as the rounded mean times the count."""
    estimate = F.round(mean("Monetary"), 2) * F.count("CustomerID")
    exact = F.sum(F.col("Monetary").cast(S.MONEY)).cast("double")
    return customers.groupBy(key).agg(
        estimate.alias("estimated_revenue"), exact.alias("exact_revenue")
    )


def segment_summary(named: DataFrame, key: str = "prediction") -> DataFrame:
    """The rows of the summary report: size, mean measures and revenue of each group, ordered by it."""
    return named.orderBy(key).select(
        key,
        "Segment_Name",
        F.col("CustomerID_count").alias("customers"),
        "Recency_mean",
        "Frequency_mean",
        "Monetary_mean",
        (F.col("Monetary_mean") * F.col("CustomerID_count")).alias("revenue"),
    )


def impact_summary(named: DataFrame) -> DataFrame:
    """Customers, VIP customers and estimated revenue over all groups, as one row."""
    vip = F.when(F.col("Segment_Name").contains("VIP"), F.col("CustomerID_count"))
    return named.agg(
        F.sum("CustomerID_count").alias("customers"),
        F.coalesce(F.sum(vip), F.lit(0)).alias("vip_customers"),
        F.sum(F.col("Monetary_mean") * F.col("CustomerID_count")).alias("revenue"),
    )
