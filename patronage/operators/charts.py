"""The aggregates behind the charts; every result is as small as the chart it feeds."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.functions.scalars import equal_width_bin
from patronage.operators.order_stats import Extent, extents, quantiles
from patronage.operators.profile import mean

BINS = 50
FREQUENCY_BOUND = 100
MONETARY_QUANTILE = 0.95


#: Parts that a group is ranked in before its sample is taken.
SALTS = 64


def _range(extent: Extent) -> tuple[float, float]:
    """Bounds to cut into bins; a constant gets half a unit on either side."""
    low, high = extent.low, extent.high
    if low is None:
        return 0.0, 1.0
    return (low - 0.5, high + 0.5) if low == high else (low, high)


def _is_number(name: str) -> Column:
    """Neither null nor NaN nor infinite: what fits into a bin."""
    return F.col(name).cast("double").between(-1.7976931348623157e308, 1.7976931348623157e308)


def histogram(rfm: DataFrame, column: str, *, bins: int = BINS) -> DataFrame:
    """Customers per equal-width bin, empty bins included."""
    low, high = _range(extents(rfm, [column])[column])
    width = (high - low) / bins
    counts = (
        rfm.filter(_is_number(column))
        .groupBy(equal_width_bin(column, low, high, bins).alias("bin"))
        .agg(F.count("*").alias("customers"))
    )
    return (
        rfm.sparkSession.range(bins)
        .select(F.col("id").cast("int").alias("bin"))
        .join(counts, "bin", "left")
        .select(
            "bin",
            (F.lit(low) + F.col("bin") * width).alias("bin_low"),
            (F.lit(low) + (F.col("bin") + 1) * width).alias("bin_high"),
            F.coalesce("customers", F.lit(0)).alias("customers"),
        )
        .orderBy("bin")
    )


def recency_histogram(rfm: DataFrame, *, bins: int = BINS) -> DataFrame:
    return histogram(rfm, "Recency", bins=bins)


def frequency_histogram(
    rfm: DataFrame, *, bins: int = BINS, bound: int = FREQUENCY_BOUND
) -> DataFrame:
    """Only customers with fewer than `bound` invoices."""
    return histogram(rfm.filter(F.col("Frequency") < bound), "Frequency", bins=bins)


def quantile(rfm: DataFrame, column: str, probability: float) -> float | None:
    """Exact quantile of a column over all customers."""
    found = quantiles(rfm, {column: [probability]}).first()
    return found["value"] if found else None


def approximate_quantiles(
    rfm: DataFrame, columns: Iterable[str], probabilities: Iterable[float], *, accuracy: int = 1000
) -> DataFrame:
    """(measure, probability, value) in one scan: values whose rank is off by at most rows / accuracy.

    The value at probability p is one of the column's own: fewer than (p + 1 / accuracy) of the
    rows lie below it, and at least (p - 1 / accuracy) of them do not lie above. Nulls and NaN are
    ignored. `quantile` is exact.
    """
    probabilities = sorted(probabilities)
    listed = F.array(*(F.lit(float(p)) for p in probabilities))
    found = rfm.agg(
        *(F.percentile_approx(F.when(_is_number(c), F.col(c).cast("double")), listed, accuracy).alias(c) for c in columns)
    )
    rows = [
        F.struct(F.lit(c).alias("measure"), F.lit(float(p)).alias("probability"), F.col(c)[i].alias("value"))
        for c in columns
        for i, p in enumerate(probabilities)
    ]
    return found.select(F.inline(F.array(*rows))).where("value IS NOT NULL")


def rank_errors(rfm: DataFrame, found: DataFrame) -> DataFrame:
    """`found` (measure, probability, value) with the share of rows by which each rank is off.

    Rows below and up to every value are counted in one scan: each row is dealt to the first value
    that it does not exceed, and running sums over the values do the rest.
    """
    values = found.groupBy("measure").agg(F.array_sort(F.collect_set("value")).alias("values"))
    columns = [r["measure"] for r in values.select("measure").collect()]
    long = rfm.select(
        F.inline(F.array(*(F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("own")) for c in columns)))
    ).where(_is_number("own"))
    # One row per measure, as many values as probabilities were asked for.
    dealt = long.join(F.broadcast(values), "measure").select(
        "measure", F.expr("get(filter(values, v -> own <= v), 0)").alias("value"), F.expr("array_contains(values, own)").alias("equal")
    )
    counts = dealt.groupBy("measure", "value").agg(F.count("*").alias("n"), F.count_if("equal").alias("ties"))
    in_order = Window.partitionBy("measure").orderBy(F.col("value").asc_nulls_last())
    counts = counts.select(
        "measure", "value", F.sum("n").over(in_order).alias("upto"), "ties",
        F.sum("n").over(Window.partitionBy("measure")).alias("rows"),
    )
    wanted = F.col("probability") * F.col("rows")
    off = F.greatest(F.col("upto") - F.col("ties") - wanted, wanted - F.col("upto"), F.lit(0.0))
    joined = found.join(counts, ["measure", "value"])
    return joined.select("measure", "probability", "value", (off / F.col("rows")).alias("rank_error"))


def below_quantile(
    rfm: DataFrame, column: str = "Monetary", probability: float = MONETARY_QUANTILE
) -> DataFrame:
    """Customers strictly below a quantile of a column."""
    return rfm.filter(F.col(column) < F.lit(quantile(rfm, column, probability)))


def monetary_histogram(rfm: DataFrame, *, bins: int = BINS) -> DataFrame:
    """Only customers strictly below the 95th percentile."""
    return histogram(below_quantile(rfm), "Monetary", bins=bins)


def grid(
    customers: DataFrame, x: str, y: str, mean_of: str, *, key: str | None = None, bins: int = BINS
) -> DataFrame:
    """Customers and the mean of a third measure per cell of two binned measures.

    Stands in for a scatter plot, whose size would grow with the customers. Cells share one
    grid over all groups when `key` splits them. Only filled cells are returned.
    """
    known = extents(customers, [x, y])
    cells = [
        equal_width_bin(m, *_range(known[m]), bins).alias(name)
        for m, name in ((x, "x_bin"), (y, "y_bin"))
    ]
    keys = [F.col(key)] if key else []
    return (
        customers.filter(_is_number(x) & _is_number(y))
        .groupBy(*keys, *cells)
        .agg(F.count("*").alias("customers"), mean(mean_of).alias(f"{mean_of}_mean"))
    )


def cube(
    customers: DataFrame,
    measures: tuple[str, str, str] = ("Recency", "Frequency", "Monetary"),
    *,
    key: str | None = None,
    bins: int = 20,
) -> DataFrame:
    """Customers per cell of three binned measures, every customer counted.

    Feeds the three-axis view and parallel coordinates, per group when `key` splits them.
    """
    known = extents(customers, measures)
    numbers = F.lit(True)
    for m in measures:
        numbers = numbers & _is_number(m)
    cells = [
        equal_width_bin(m, *_range(known[m]), bins).alias(name)
        for m, name in zip(measures, ("x_bin", "y_bin", "z_bin"), strict=True)
    ]
    keys = [F.col(key)] if key else []
    return customers.filter(numbers).groupBy(*keys, *cells).agg(F.count("*").alias("customers"))


def box_statistics(customers: DataFrame, column: str, key: str = "prediction") -> DataFrame:
    """Box plot numbers per group, for any number of groups.

    Quartiles are exact. Whiskers end at the outermost values within 1.5 interquartile ranges
    of the box, or at the box where there are none, and everything beyond counts as outlier.
    """
    parts = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    found = quantiles(customers, {column: parts.values()}, group=key)
    at = {name: F.max(F.when(F.col("probability") == p, F.col("value"))) for name, p in parts.items()}
    boxes = found.groupBy("group").agg(*(value.alias(name) for name, value in at.items()))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    boxes = boxes.withColumns({"low": F.col("q1") - reach, "high": F.col("q3") + reach})
    # One row per group; the planner decides by their number how to join.
    boxed = customers.select(key, F.col(column).cast("double").alias("value")).join(
        boxes, F.col(key).eqNullSafe(F.col("group"))
    )
    within = F.when(F.expr("value BETWEEN low AND high"), F.col("value"))
    return (
        boxed.groupBy(key, "q1", "median", "q3")
        .agg(
            F.count("value").alias("customers"),
            F.min(within).alias("lowest"),
            F.max(within).alias("highest"),
            F.count_if(F.expr("value < low OR value > high")).alias("outliers"),
        )
        .select(
            key,
            "customers",
            "q1",
            "median",
            "q3",
            F.least("q1", "lowest").alias("whisker_low"),
            F.greatest("q3", "highest").alias("whisker_high"),
            "outliers",
        )
    )


def point_sample(
    customers: DataFrame, rows: int, key: str = "prediction", *, seed: int = 42
) -> DataFrame:
    """At most `rows` customers per group, and `group_customers`, the full size of the group.

    The customers whose hashed ids come first are taken. Each group is ranked in salted parts
    first, of which at most `rows` go on, so no group is gathered in one task. The choice depends
    only on the ids.
    """
    hashed = customers.withColumn("sample_hash", F.md5(F.concat_ws(":", F.lit(str(seed)), "CustomerID")))
    salt = F.pmod(F.hash("sample_hash"), F.lit(SALTS))
    order = ["sample_hash", "CustomerID"]
    for part in ([F.col(key), salt], [F.col(key)]):
        place = F.row_number().over(Window.partitionBy(*part).orderBy(*order))
        hashed = hashed.withColumn("sample_place", place).filter(F.col("sample_place") <= rows)
    sizes = customers.groupBy(F.col(key).alias("sized")).agg(F.count("*").alias("group_customers"))
    return hashed.join(sizes, F.col(key).eqNullSafe(F.col("sized"))).drop(
        "sample_hash", "sample_place", "sized"
    )
