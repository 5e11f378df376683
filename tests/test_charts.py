"""Chart aggregates against numpy and brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.operators import charts
from patronage.operators.measures import rfm
from patronage.operators.quartiles import quartiles
from patronage.sources import tables


@pytest.fixture(scope="module")
def customers(spark, medium):
    return quartiles(rfm(tables.invoices(spark, medium)))


@pytest.fixture(scope="module")
def local(customers):
    return customers.select(
        "CustomerID", "Recency", "Frequency", "Monetary", "R_Quartile"
    ).toPandas()


def _counts(df):
    return [r.customers for r in df.collect()]


def test_histograms_equal_numpy(customers, local):
    money = local.Monetary[local.Monetary < local.Monetary.quantile(0.95)]
    frequency = local.Frequency[local.Frequency < 100]
    for df, values in (
        (charts.recency_histogram(customers), local.Recency),
        (charts.frequency_histogram(customers), frequency),
        (charts.monetary_histogram(customers), money),
    ):
        counts, edges = np.histogram(values, bins=50)
        assert _counts(df) == counts.tolist()
        assert [r.bin_low for r in df.collect()] == pytest.approx(edges[:-1].tolist())


@pytest.mark.parametrize("values", [[3.0] * 5, [0.0, 0.1, 0.2, 0.3, 0.7, 1.0], [1e-3, 1e9, 5.0]])
def test_histogram_edges(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "Recency double")
    assert _counts(charts.histogram(df, "Recency")) == np.histogram(values, bins=50)[0].tolist()


def test_histogram_of_many_exact_edges(spark):
    values = [i * 0.1 for i in range(500)] + [i / 7 for i in range(351)]
    df = spark.createDataFrame([(v,) for v in values], "Recency double")
    for bins in (10, 49, 50):
        expected = np.histogram(values, bins=bins)[0].tolist()
        assert _counts(charts.histogram(df, "Recency", bins=bins)) == expected


def test_histogram_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "Recency double")
    assert _counts(charts.histogram(df, "Recency")) == [0] * 50


def test_grid_counts_everyone(customers, local):
    cells = charts.grid(customers, "Recency", "Frequency", "Monetary").toPandas()
    counts, _, _ = np.histogram2d(local.Recency, local.Frequency, bins=50)
    found = np.zeros((50, 50))
    found[cells.x_bin, cells.y_bin] = cells.customers
    assert (found == counts).all()
    total = (cells.Monetary_mean * cells.customers).sum()
    assert total == pytest.approx(local.Monetary.sum())
    split = charts.grid(customers, "Recency", "Frequency", "Monetary", key="R_Quartile")
    assert split.agg(F.sum("customers")).first()[0] == len(local)


@pytest.mark.parametrize("column", ["Recency", "Monetary"])
def test_boxes(customers, local, column):
    for r in charts.box_statistics(customers, column, "R_Quartile").collect():
        values = local[column][local.R_Quartile == r.R_Quartile].to_numpy(dtype=float)
        q1, median, q3 = np.percentile(values, [25, 50, 75])
        reach = 1.5 * (q3 - q1)
        inside = values[(values >= q1 - reach) & (values <= q3 + reach)]
        assert (r.q1, r.median, r.q3) == pytest.approx((q1, median, q3))
        assert r.whisker_low == min(q1, inside.min())
        assert r.whisker_high == max(q3, inside.max())
        assert r.outliers == len(values) - len(inside)
        assert r.customers == len(values)


def test_boxes_of_many_groups(spark):
    df = spark.range(30_000).select(
        F.col("id").alias("CustomerID"),
        F.col("id").cast("double").alias("Recency"),
        (F.col("id") % 10_000).alias("prediction"),
    )
    rows = charts.box_statistics(df, "Recency").filter("prediction in (0, 77, 9999)").collect()
    assert {(r.prediction, r.q1, r.median, r.q3) for r in rows} == {
        (g, g + 5000.0, g + 10_000.0, g + 15_000.0) for g in (0, 77, 9999)
    }


def test_box_of_one_member(spark):
    df = spark.createDataFrame([(1, 5.0, 0)], "CustomerID bigint, Recency double, prediction int")
    row = charts.box_statistics(df, "Recency").first()
    assert tuple(row) == (0, 1, 5.0, 5.0, 5.0, 5.0, 5.0, 0)


def test_point_sample(customers, local):
    sample = charts.point_sample(customers, 50, "R_Quartile")
    chosen = sample.toPandas()
    assert sorted(chosen.columns) == sorted([*customers.columns, "group_customers"])
    assert chosen.groupby("R_Quartile").size().to_dict() == {1: 50, 2: 50, 3: 50, 4: 50}
    assert set(chosen.CustomerID) <= set(local.CustomerID)
    sizes = local.groupby("R_Quartile").size().to_dict()
    assert chosen.groupby("R_Quartile").group_customers.first().to_dict() == sizes
    again = charts.point_sample(customers.repartition(7), 50, "R_Quartile")
    assert {r.CustomerID for r in again.collect()} == set(chosen.CustomerID)
    assert charts.point_sample(customers, 10**6, "R_Quartile").count() == len(local)


def test_cube_counts_everyone(customers, local):
    cells = charts.cube(customers, key="R_Quartile")
    assert cells.agg(F.sum("customers")).first()[0] == len(local)


def test_values_that_are_no_numbers_are_in_no_bin(spark):
    rows = [(1, float("nan")), (2, float("inf")), (3, 1.0), (4, 2.0), (5, None)]
    df = spark.createDataFrame(rows, "CustomerID bigint, Recency double")
    assert charts.histogram(df, "Recency").agg(F.sum("customers")).first()[0] == 2
