"""Recency, frequency, monetary value and four more measures per customer."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage import schema as S
from patronage.functions.scalars import cents
from patronage.staging import stage


#: Registers of an invoice sketch, as a power of two.
SKETCH_LG_K = 12


def snapshot(cleaned: DataFrame, date: str = "InvoiceDate") -> DataFrame:
    """The latest date in cleaned lines or, from their `LastDate`, in invoices, as one row."""
    return cleaned.agg(F.max(date).alias("snapshot_date"))


def snapshot_of(rfm: DataFrame) -> DataFrame:
    """The date that a customer table counts its Recency back from, as one row."""
    day = F.date_add(F.to_date("LastPurchaseDate"), F.col("Recency"))
    return rfm.agg(F.max(day).alias("snapshot_date"))


def invoice_facts(cleaned: DataFrame) -> DataFrame:
    """One row per customer and invoice.

    Grouping by invoice first makes distinct invoices a plain count later, and spreads a
    customer who holds a large share of all lines over as many tasks as there are invoices.
    """
    return cleaned.groupBy("CustomerID", "InvoiceNo").agg(
        F.sum(cents(F.col("TotalAmount"))).alias("Cents"),
        F.count("*").alias("Lines"),
        F.min("InvoiceDate").alias("FirstDate"),
        F.max("InvoiceDate").alias("LastDate"),
    )


def customer_measures(facts: DataFrame) -> DataFrame:
    """Everything about a customer that does not depend on the snapshot date.

    Lines without an invoice number add to money but not to invoices or transactions.
    """
    amount = (F.sum(F.col("Cents").cast(S.CENTS)) / 100).cast("double")
    numbered = F.when(F.col("InvoiceNo").isNotNull(), F.col("Lines"))
    return facts.groupBy("CustomerID").agg(
        F.count("InvoiceNo").alias("Frequency"),
        amount.alias("Monetary"),
        F.coalesce(F.sum(numbered), F.lit(0)).cast("bigint").alias("TotalTransactions"),
        (amount / F.sum("Lines")).alias("AvgTransactionValue"),
        F.min("FirstDate").alias("FirstPurchaseDate"),
        F.max("LastDate").alias("LastPurchaseDate"),
    )


def daily_facts(cleaned: DataFrame, *, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """One row per customer and day, invoices as a HyperLogLog sketch instead of one row each.

    Days can be stored as they come and merged later in any order; `customer_measures_of_days`
    does that. An invoice with lines on several days counts once. Lines without a readable date
    share the day null.
    """
    amount = cents(F.col("TotalAmount"))
    return cleaned.groupBy("CustomerID", F.to_date("InvoiceDate").alias("Day")).agg(
        F.hll_sketch_agg("InvoiceNo", lg_k).alias("Invoices"),
        F.sum(amount).alias("Cents"),
        F.count("*").alias("Lines"),
        F.count("InvoiceNo").alias("NumberedLines"),
        F.min("InvoiceDate").alias("FirstDate"),
        F.max("InvoiceDate").alias("LastDate"),
    )


def customer_measures_of_days(days: DataFrame) -> DataFrame:
    """As `customer_measures`, from `daily_facts`: Frequency is the merged sketches' estimate.

    Up to some dozens of invoices the estimate is the exact number; beyond, its relative standard
    error is about 1.04 / sqrt(2 ^ lg_k), 1.6 % by default. All else is exact.
    """
    amount = (F.sum(F.col("Cents").cast(S.CENTS)) / 100).cast("double")
    return days.groupBy("CustomerID").agg(
        F.hll_sketch_estimate(F.hll_union_agg("Invoices")).alias("Frequency"),
        amount.alias("Monetary"),
        F.sum("NumberedLines").alias("TotalTransactions"),
        (amount / F.sum("Lines")).alias("AvgTransactionValue"),
        F.min("FirstDate").alias("FirstPurchaseDate"),
        F.max("LastDate").alias("LastPurchaseDate"),
    )


def rfm_of_days(days: DataFrame, *, as_of: datetime.date | None = None) -> DataFrame:
    """As `rfm`, with approximate Frequency, from a stored table of `daily_facts`."""
    return with_recency(stage(customer_measures_of_days(days), "customers"), as_of=as_of)


def rfm(facts: DataFrame, *, as_of: datetime.date | None = None) -> DataFrame:
    """One row per customer, with Recency counted in calendar days.

    The customer table is staged, so the source is read once however many operators follow.
    The snapshot is the latest purchase date of that table unless `as_of` is given: one staged
    row, which every later plan takes as a scalar. A customer without any readable date has a
    null Recency.
    """
    return with_recency(stage(customer_measures(facts), "customers"), as_of=as_of)


def with_recency(customers: DataFrame, *, as_of: datetime.date | None = None) -> DataFrame:
    """A staged table of `customer_measures` with Recency, in the usual order of columns."""
    if as_of is None:
        latest = customers.agg(F.to_date(F.max("LastPurchaseDate")).alias("day"))
        day = stage(latest, "snapshot").scalar()
    else:
        day = F.lit(as_of).cast("date")
    recency = F.datediff(day, F.to_date("LastPurchaseDate"))
    return customers.select(
        "CustomerID",
        recency.alias("Recency"),
        "Frequency",
        "Monetary",
        "TotalTransactions",
        "AvgTransactionValue",
        "FirstPurchaseDate",
        "LastPurchaseDate",
    )
