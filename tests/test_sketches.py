"""Sketches: brackets that err are widened, estimates stay near, approximate ranks within their bound."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from patronage.operators import charts, order_stats
from patronage.operators import measures as M
from patronage.operators.cleaning import clean
from patronage.operators.quartiles import quartiles, tile_columns
from patronage.sources import tables
from patronage.staging import stage


def _ntile(df, measure, tiles):
    order = Window.orderBy(F.col(measure).asc_nulls_first(), "CustomerID")
    return {r[0]: r[1] for r in df.select("CustomerID", F.ntile(tiles).over(order)).collect()}


@pytest.fixture(scope="module")
def wide(spark):
    """Continuous, tied, half null and wholly equal columns over more rows than a sketch holds."""
    random.seed(3)
    rows = [
        (i * 7919 % 1_000_003, random.gauss(0, 1e6), random.choice([1, 2, 2, 2, 9]), None if i % 2 else i % 13, 4.0)
        for i in range(30_000)
    ]
    return stage(spark.createDataFrame(rows, "CustomerID long, A double, B int, C int, D double").repartition(5), "wide")


@pytest.mark.parametrize("accuracy", [8, 200])
@pytest.mark.parametrize("tiles", [4, 30])
def test_tiles_beyond_a_sketch(wide, accuracy, tiles):
    columns = tile_columns(wide, [(m, tiles) for m in "ABCD"], accuracy=accuracy, finish_rows=50)
    for m in "ABCD":
        found = {r[0]: r[1] for r in wide.select("CustomerID", columns[m, tiles]).collect()}
        assert found == _ntile(wide, m, tiles)


def test_a_sketch_that_errs_is_noticed(wide, monkeypatch):
    """Brackets far too narrow for the sketch are widened until the ranks lie inside."""
    slacks = []
    real = order_stats._bracketed

    def watched(*args):
        slacks.append(args[-1])
        return real(*args)

    monkeypatch.setattr(order_stats, "_bracketed", watched)
    monkeypatch.setattr(order_stats, "_slack", lambda accuracy: 1e-6)
    found = order_stats.quantiles(wide, {"A": [0.1, 0.5, 0.9]}, accuracy=8, finish_rows=10).collect()
    exact = wide.agg(F.percentile("A", F.array(*map(F.lit, (0.1, 0.5, 0.9))))).first()[0]
    assert [r.value for r in sorted(found, key=lambda r: r.probability)] == pytest.approx(exact, rel=1e-12)
    assert len(slacks) > 1


def test_three_scans(wide, monkeypatch):
    """Bounds, counts and the ids at borders: no further pass over the rows."""
    passes = []
    for name in ("_bracketed", "_counted", "ids_at"):
        real = getattr(order_stats, name)
        monkeypatch.setattr(order_stats, name, lambda *a, real=real, name=name, **k: passes.append(name) or real(*a, **k))
    tile_columns(wide, [("A", 100)])
    assert passes in (["_bracketed", "_counted"], ["_bracketed", "_counted", "ids_at"])


def test_only_the_asked_quartiles(wide):
    renamed = wide.withColumnsRenamed({"A": "Recency", "B": "Frequency", "D": "Monetary"})
    columns = quartiles(renamed, measures=["Recency"]).columns
    assert "R_Quartile" in columns and not {"F_Quartile", "M_Quartile", "RFM_Score"} & set(columns)


def test_approximate_quantiles_and_their_errors(wide):
    found = charts.approximate_quantiles(wide, ["A", "B", "C"], [0.0, 0.25, 0.5, 0.99, 1.0], accuracy=500)
    errors = charts.rank_errors(wide, stage(found, "approximate")).collect()
    assert len(errors) == 15
    assert all(r.rank_error <= 1 / 500 for r in errors)
    wrong = found.withColumn("value", F.when(F.col("measure") == "A", F.lit(1e12)).otherwise(F.col("value")))
    bad = charts.rank_errors(wide, stage(wrong.where("measure = 'A' and probability < 1"), "wrong")).collect()
    assert bad == [] or all(r.rank_error > 1 / 500 for r in bad)
    empty = charts.approximate_quantiles(wide.limit(0), ["A"], [0.5])
    assert empty.count() == 0


def test_invoice_sketches_merge_by_day(spark):
    """Invoices that span days, lines without number or date, and one customer with very many."""
    lines = spark.range(60_000).select(
        F.when(F.col("id") < 50_000, 1).otherwise(2 + F.col("id") % 40).cast("long").alias("CustomerID"),
        F.when(F.col("id") % 97 != 0, F.concat(F.lit("n"), (F.col("id") / 2).cast("long"))).alias("InvoiceNo"),
        F.when(F.col("id") % 31 != 0, F.expr("timestamp '2024-01-01' + make_interval(0, 0, 0, int(id % 9))")).alias("InvoiceDate"),
        F.lit(1.25).alias("TotalAmount"),
    )
    days = stage(M.daily_facts(lines), "days")
    parts = [days.where(F.pmod(F.dayofmonth("Day"), F.lit(2)) == n) for n in (0, 1)] + [days.where("Day is null")]
    merged = M.rfm_of_days(parts[2].union(parts[1]).union(parts[0]))
    exact = M.rfm(M.invoice_facts(lines))
    rest = ["CustomerID", "Recency", "Monetary", "TotalTransactions", "AvgTransactionValue", "FirstPurchaseDate", "LastPurchaseDate"]
    assert sorted(map(tuple, merged.select(rest).collect())) == sorted(map(tuple, exact.select(rest).collect()))
    estimates = {r.CustomerID: r.Frequency for r in merged.collect()}
    for r in exact.collect():
        assert estimates[r.CustomerID] == pytest.approx(r.Frequency, rel=0.05)
    assert exact.where("CustomerID = 1").first().Frequency > 20_000
    assert M.customer_measures_of_days(days.limit(0)).count() == 0


def test_sketched_measures_of_the_tables(spark, small):
    lines = clean(tables.lines(spark, small, dirty=True))
    found = M.rfm_of_days(stage(M.daily_facts(lines), "days"))
    exact = M.rfm(tables.invoices(spark, small, dirty=True))
    assert sorted(map(str, found.collect())) == sorted(map(str, exact.collect()))
