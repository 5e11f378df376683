"""Transaction lines and invoices from order and line-item tables.

`lines` gives one row per line. `invoices` and `cleaning_stats` give the same data already
summed, with the sums made on the line items *before* they meet their orders: the join then
carries one row per order, and an order that holds a large share of all lines is reduced on
the map side instead of landing in one join task.

`dirty=True` plants missing customers, returns, free items and text dates by fixed rules on
the keys, so cleaning has something to do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage import schema as S
from patronage.functions.scalars import cents, line_amount, parse_invoice_date
from patronage.operators.cleaning import (
    ON_BAD_DATE,
    clean,
    line_counters,
    sum_counters,
    usable_line,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _quantity(dirty: bool) -> Column:
    plain = F.col("l_quantity")
    if not dirty:
        return plain
    returned = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
    return F.when(returned, -plain).otherwise(plain)


def _price(dirty: bool) -> Column:
    plain = F.col("l_extendedprice") / F.col("l_quantity")
    if not dirty:
        return plain
    free = (F.col("l_discount") == 0) & (F.col("l_linenumber") == 2)
    return F.when(free, 0.0).otherwise(plain)


def _customer(dirty: bool) -> Column:
    plain = F.col("o_custkey")
    return F.when(F.col("o_orderkey") % 20 != 0, plain) if dirty else plain


def _date(dirty: bool) -> Column:
    plain = F.col("o_orderdate").cast("timestamp")
    if not dirty:
        return plain
    style = F.col("o_orderkey") % 3
    return (
        F.when(F.col("o_orderkey") % 101 == 0, "not a date")
        .when(style == 0, F.date_format(plain, S.DATE_FORMATS[0]))
        .when(style == 1, F.date_format(plain, S.DATE_FORMATS[1]))
        .otherwise(F.date_format(plain, S.DATE_FORMATS[2]))
    )


def _items(spark: SparkSession, folder: str, dirty: bool) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        "l_orderkey", _quantity(dirty).alias("Quantity"), _price(dirty).alias("UnitPrice")
    )


def _orders(spark: SparkSession, folder: str, dirty: bool) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("InvoiceNo"),
        _customer(dirty).alias("CustomerID"),
        _date(dirty).alias("InvoiceDate"),
        "o_custkey",
    )


def lines(
    spark: SparkSession, folder: str, *, dirty: bool = False, country: bool = False
) -> DataFrame:
    """One row per line item, in the shape of a raw transaction file."""
    orders = _orders(spark, folder, dirty)
    columns = ["CustomerID", "InvoiceNo", "InvoiceDate", "Quantity", "UnitPrice"]
    if country:
        # Joined to the orders, before they fan out to lines.
        customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
        nations = table(spark, folder, "nation").select(
            "n_nationkey", F.col("n_name").alias("Country")
        )
        orders = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").join(
            nations, F.col("c_nationkey") == F.col("n_nationkey"), "left"
        )
        columns.append("Country")
    # As text, an invoice number no longer carries the partitioning of the join, so grouping
    # by invoice later has its own shuffle and leaves adaptive execution free to split an
    # order that holds a large share of all lines.
    joined = _items(spark, folder, dirty).join(orders, F.col("l_orderkey") == F.col("InvoiceNo"))
    return joined.withColumn("InvoiceNo", F.col("InvoiceNo").cast("string")).select(*columns)


def first_lines(spark: SparkSession, folder: str, *, rows: int = 10, dirty: bool = False) -> DataFrame:
    """A few cleaned lines: of a few orders, picked before the join, so no table is shuffled."""
    orders = _orders(spark, folder, dirty).filter(F.col("CustomerID").isNotNull()).limit(10 * rows)
    items = _items(spark, folder, dirty)
    # At most 10 x `rows` orders are broadcast.
    few = items.join(F.broadcast(orders), F.col("l_orderkey") == F.col("InvoiceNo"))
    few = few.withColumn("InvoiceNo", F.col("InvoiceNo").cast("string"))
    columns = ["CustomerID", "InvoiceNo", "InvoiceDate", "Quantity", "UnitPrice"]
    return clean(few.select(*columns)).limit(rows)


def cleaning_stats(
    spark: SparkSession, folder: str, *, dirty: bool = False, on_bad_date: str = "keep"
) -> DataFrame:
    """Equal to `cleaning.cleaning_stats(lines(...))`, counting per order before the join."""
    per_order = (
        _items(spark, folder, dirty)
        .withColumns(line_counters())
        .groupBy("l_orderkey")
        .agg(*(F.sum(name).alias(name) for name in line_counters()))
    )
    orders = _orders(spark, folder, dirty)
    date = parse_invoice_date("InvoiceDate", orders.schema["InvoiceDate"].dataType)
    orders = orders.select(
        "InvoiceNo",
        F.col("CustomerID").isNotNull().alias("known"),
        date.isNotNull().alias("dated"),
    )
    counted = per_order.join(orders, F.col("l_orderkey") == F.col("InvoiceNo"))
    return sum_counters(counted, on_bad_date=on_bad_date)


def invoices(
    spark: SparkSession, folder: str, *, dirty: bool = False, on_bad_date: str = "keep"
) -> DataFrame:
    """Cleaned lines summed per invoice; equal to `invoice_facts(clean(lines(...)))`."""
    if on_bad_date not in ON_BAD_DATE:
        raise ValueError(f"on_bad_date must be one of {ON_BAD_DATE}")
    per_order = (
        _items(spark, folder, dirty)
        .filter(usable_line())
        .groupBy("l_orderkey")
        .agg(
            F.sum(cents(line_amount(F.col("Quantity"), F.col("UnitPrice")))).alias("Cents"),
            F.count("*").alias("Lines"),
        )
    )
    orders = _orders(spark, folder, dirty).filter(F.col("CustomerID").isNotNull())
    orders = orders.withColumn(
        "InvoiceDate", parse_invoice_date("InvoiceDate", orders.schema["InvoiceDate"].dataType)
    )
    if on_bad_date == "drop":
        orders = orders.filter(F.col("InvoiceDate").isNotNull())
    # The last grouping needs no shuffle: the join has already placed rows by order.
    return (
        per_order.join(orders, F.col("l_orderkey") == F.col("InvoiceNo"))
        .groupBy("CustomerID", "InvoiceNo")
        .agg(
            F.sum("Cents").alias("Cents"),
            F.sum("Lines").alias("Lines"),
            F.min("InvoiceDate").alias("FirstDate"),
            F.max("InvoiceDate").alias("LastDate"),
        )
    )
