"""Drop unusable lines, normalise dates, compute the line amount, and count what went."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage import schema as S
from patronage.functions.scalars import line_amount, parse_invoice_date, percentage

ON_BAD_DATE = ("keep", "drop")


# Cents of a larger amount do not fit a bigint.
AMOUNT_BOUND = 9e16


def _positive(name: str) -> Column:
    """Above zero and a number: neither null nor NaN nor infinite."""
    return (F.col(name) > 0) & (F.col(name) < float("inf"))


def usable_line() -> Column:
    """Positive finite quantity and price whose product is representable; nulls do not pass."""
    small = F.col("Quantity") * F.col("UnitPrice") < AMOUNT_BOUND / 100
    return _positive("Quantity") & _positive("UnitPrice") & small


def clean(
    lines: DataFrame, *, formats: Sequence[str] = S.DATE_FORMATS, on_bad_date: str = "keep"
) -> DataFrame:
    """Lines of known customers with positive quantity and price.

    `InvoiceDate` becomes a timestamp and `TotalAmount` is added. A line whose date cannot be
    read stays, with a null date, and still counts towards frequency and money, unless
    `on_bad_date="drop"`.
    """
    if on_bad_date not in ON_BAD_DATE:
        raise ValueError(f"on_bad_date must be one of {ON_BAD_DATE}")
    date_type = lines.schema["InvoiceDate"].dataType
    cleaned = (
        lines.filter(F.col("CustomerID").isNotNull() & usable_line())
        .withColumn("InvoiceDate", parse_invoice_date("InvoiceDate", date_type, formats))
        .withColumn("TotalAmount", line_amount(F.col("Quantity"), F.col("UnitPrice")))
    )
    return cleaned.filter(F.col("InvoiceDate").isNotNull()) if on_bad_date == "drop" else cleaned


def line_counters() -> dict[str, Column]:
    """What one line adds to the cleaning statistics, apart from its customer and date."""
    usable = F.coalesce(usable_line(), F.lit(False))
    bad_quantity = ~F.coalesce(_positive("Quantity"), F.lit(False))
    bad_price = ~F.coalesce(_positive("UnitPrice"), F.lit(False))
    return {
        "lines": F.lit(1).cast("bigint"),
        "usable": usable.cast("bigint"),
        "bad_quantity": bad_quantity.cast("bigint"),
        "bad_price": bad_price.cast("bigint"),
    }


def sum_counters(counted: DataFrame, *, on_bad_date: str = "keep") -> DataFrame:
    """One row of statistics from counters beside the flags `known` and `dated`.

    A row may stand for one line or for many lines of one customer and date.
    """
    if on_bad_date not in ON_BAD_DATE:
        raise ValueError(f"on_bad_date must be one of {ON_BAD_DATE}")
    kept = "known AND dated" if on_bad_date == "drop" else "known"
    totals = {
        "original_count": "lines",
        "cleaned_count": f"CASE WHEN {kept} THEN usable END",
        "unknown_customer_count": "CASE WHEN NOT known THEN lines END",
        "bad_quantity_count": "bad_quantity",
        "bad_price_count": "bad_price",
        "bad_date_count": "CASE WHEN known AND usable > 0 AND NOT dated THEN usable END",
    }
    counts = counted.agg(
        *(F.expr(f"coalesce(sum({of}), 0L)").alias(name) for name, of in totals.items())
    )
    original, cleaned = F.col("original_count"), F.col("cleaned_count")
    return counts.select(
        "original_count",
        "cleaned_count",
        (original - cleaned).alias("removed_count"),
        percentage(cleaned, original).alias("retention_rate"),
        "unknown_customer_count",
        "bad_quantity_count",
        "bad_price_count",
        "bad_date_count",
    )


def cleaning_stats(
    lines: DataFrame, *, formats: Sequence[str] = S.DATE_FORMATS, on_bad_date: str = "keep"
) -> DataFrame:
    """One row of counts before and after cleaning, from a single pass over the lines."""
    date = parse_invoice_date("InvoiceDate", lines.schema["InvoiceDate"].dataType, formats)
    counted = lines.select(
        F.col("CustomerID").isNotNull().alias("known"),
        date.isNotNull().alias("dated"),
        *(counter.alias(name) for name, counter in line_counters().items()),
    )
    return sum_counters(counted, on_bad_date=on_bad_date)


def preview(lines: DataFrame, rows: int = 10, *, ordered: bool = True) -> DataFrame:
    """A few lines to look at.

    In the order of all columns the choice is repeatable, but finding it takes a pass over
    the data; unordered, only as much is read as it takes to fill the rows.
    """
    return (lines.orderBy(*lines.columns) if ordered else lines).limit(rows)
