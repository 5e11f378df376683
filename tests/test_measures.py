"""Customer measures and quartiles against plain definitions."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from patronage.operators.cleaning import clean
from patronage.operators.measures import invoice_facts, rfm
from patronage.operators.order_stats import quantiles, values_at
from patronage.operators.quartiles import last_ranks, quartiles, tile_columns
from patronage.sources import tables
from tests.test_cleaning import frame


def test_measures_of_hand_made_customers(spark):
    lines = frame(
        spark,
        (1, "A", "12/1/2010 8:26", 2.0, 1.255),
        (1, "A", "12/1/2010 8:26", 1.0, 1.0),
        (1, "B", "12/3/2010 23:59", 1.0, 5.0),
        (1, None, "12/2/2010 10:00", 1.0, 7.0),
        (2, "C", "12/4/2010 0:01", 3.0, 1.0),
        (3, "D", "junk", 1.0, 9.0),
    )
    rows = {r.CustomerID: r for r in rfm(invoice_facts(clean(lines))).collect()}
    one = rows[1]
    assert one.Recency == 1  # two minutes, but across midnight
    assert one.Frequency == 2 and one.TotalTransactions == 3
    assert one.Monetary == 15.51
    assert one.AvgTransactionValue == pytest.approx(15.51 / 4)
    assert one.FirstPurchaseDate == dt.datetime(2010, 12, 1, 8, 26)
    assert one.LastPurchaseDate == dt.datetime(2010, 12, 3, 23, 59)
    assert rows[2].Recency == 0
    assert rows[3].Recency is None and rows[3].Monetary == 9.0
    later = rfm(invoice_facts(clean(lines)), as_of=dt.date(2010, 12, 14)).collect()
    assert {r.CustomerID: r.Recency for r in later} == {1: 11, 2: 10, 3: None}


def test_no_readable_date_at_all(spark):
    table = quartiles(rfm(invoice_facts(clean(frame(spark, (1, "A", "junk", 1.0, 1.0))))))
    assert table.first().Recency is None
    assert table.first().R_Quartile == 1


@pytest.mark.parametrize("on_bad_date", ["keep", "drop"])
@pytest.mark.parametrize("dirty", [False, True])
def test_sums_before_the_join_equal_sums_after(spark, small, dirty, on_bad_date):
    lines = clean(tables.lines(spark, small, dirty=dirty), on_bad_date=on_bad_date)
    late = invoice_facts(lines).withColumn("InvoiceNo", F.col("InvoiceNo").cast("bigint"))
    early = tables.invoices(spark, small, dirty=dirty, on_bad_date=on_bad_date)
    columns = early.columns
    assert late.select(columns).exceptAll(early).count() == 0
    assert early.exceptAll(late.select(columns)).count() == 0


def test_partitioning_does_not_change_results(spark, small):
    facts = invoice_facts(clean(tables.lines(spark, small, dirty=True)))
    results = [
        sorted(map(str, quartiles(rfm(facts.repartition(n))).collect())) for n in (1, 4, 16)
    ]
    assert results[0] == results[1] == results[2]


def _with_windows(df, tiles=4):
    order = {m: Window.orderBy(F.col(m).asc_nulls_first(), "CustomerID") for m in ("A", "B")}
    return df.select("CustomerID", *(F.ntile(tiles).over(w).alias(m) for m, w in order.items()))


def _distributed(df, tiles=4, **limits):
    columns = tile_columns(df, [("A", tiles), ("B", tiles)], **limits)
    return df.select("CustomerID", *(columns[m, tiles].alias(m) for m in ("A", "B")))


def _same(a, b):
    return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


@pytest.mark.parametrize("n", (0, 1, 4, 7, 9))
def test_tiles_of_few_rows(spark, n):
    df = spark.createDataFrame(
        [(i, None if i % 4 == 3 else i % 3, float(-i)) for i in range(n)],
        "CustomerID bigint, A int, B double",
    )
    assert _same(_distributed(df), _with_windows(df))


@pytest.mark.parametrize("tiles", [2, 4, 7])
def test_tiles_under_heavy_ties_and_nulls(spark, tiles):
    """A third of the rows share one value, a third are null, the rest spread widely."""
    df = _materialised(spark)
    assert _same(_distributed(df, tiles, accuracy=64, finish_rows=5), _with_windows(df, tiles))


def _materialised(spark):
    random.seed(7)
    rows = []
    for i in range(3000):
        a = (5, i, None)[i % 3]
        b = -7.25 if i % 3 == 0 else random.choice((-1, 1)) * 10.0 ** random.uniform(-9, 12)
        rows.append((random.getrandbits(64) - 2**63, a, b))
    return spark.createDataFrame(rows, "CustomerID bigint, A int, B double").repartition(5)


def test_text_ids_break_ties_by_hash(spark):
    df = spark.createDataFrame(
        [(f"c'{i}", 1, float(i % 5)) for i in range(500)], "CustomerID string, A int, B double"
    )
    tiles = _distributed(df, accuracy=64, finish_rows=3)
    sizes = {r.A: r["count"] for r in tiles.groupBy("A").count().collect()}
    assert sizes == {1: 125, 2: 125, 3: 125, 4: 125}
    hashed = df.withColumn("h", F.xxhash64("CustomerID"))
    order = Window.orderBy("B", "h", "CustomerID")
    expected = hashed.select("CustomerID", F.ntile(4).over(order).alias("B"))
    assert _same(tiles.select("CustomerID", "B"), expected)


def test_last_ranks_match_ntile_sizes():
    for n in range(60):
        for tiles in (2, 4, 9):
            sizes = [n // tiles + (i < n % tiles) for i in range(tiles)]
            assert last_ranks(n, tiles) == [sum(sizes[: i + 1]) for i in range(tiles - 1)]


def test_quartile_plans_move_no_customers(spark, small):
    table = quartiles(rfm(tables.invoices(spark, small)))
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Window" not in plan


def test_quantiles_of_groups(spark):
    df = _materialised(spark).withColumn("g", F.col("CustomerID") % 3)
    found = quantiles(
        df,
        {"A": [0.25, 0.5], "B": [0.0, 0.95, 1.0]},
        group="g",
        accuracy=100,
        finish_rows=4,
    ).collect()
    exact = {
        (r.g, m, p): r[f"{m}{p}"]
        for r in df.groupBy("g").agg(
            *(F.percentile(m, F.lit(p)).alias(f"{m}{p}") for m in "AB" for p in (0.25, 0.5, 0.0, 0.95, 1.0))
        ).collect()
        for m in "AB"
        for p in (0.25, 0.5, 0.0, 0.95, 1.0)
    }
    for r in found:
        assert r.value == pytest.approx(exact[r.group, r.measure, r.probability], rel=1e-12)
    assert len(found) == len({r.g for r in df.select("g").distinct().collect()}) * 5


def test_quantiles_without_values(spark):
    df = spark.createDataFrame([(1, None)], "CustomerID bigint, A double")
    assert quantiles(df, {"A": [0.5]}).count() == 0


def test_values_that_are_not_finite_have_places(spark):
    values = [float("nan"), None, 2.0, float("inf"), float("-inf"), 1.0]
    df = spark.createDataFrame(list(enumerate(values)), "CustomerID bigint, A double")
    tile = tile_columns(df, [("A", 6)], finish_rows=0)["A", 6]
    found = {r.CustomerID: r.tile for r in df.select("CustomerID", tile.alias("tile")).collect()}
    assert found == {1: 1, 4: 2, 5: 3, 2: 4, 3: 5, 0: 6}


def test_text_groups_and_a_null_group(spark):
    df = spark.createDataFrame(
        [(i, float(i), ("it's", "b\\", None)[i % 3]) for i in range(90)],
        "CustomerID bigint, A double, g string",
    )
    cuts = values_at(df, {"A": {0.33: "10"}}, nulls=True, group="g", accuracy=8, finish_rows=0)
    assert {r["group"]: r["value"] for r in cuts.collect()} == {"it's": 27.0, "b\\": 28.0, None: 29.0}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.one_of(
            st.none(),
            st.integers(-3, 3).map(float),
            st.floats(allow_nan=False, allow_infinity=False),
        ),
        min_size=1,
        max_size=60,
    ),
    st.integers(2, 6),
)
def test_tiles_of_any_values(spark, values, tiles):
    rows = [(i * 7919 % 104729, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "CustomerID bigint, A double")
    columns = tile_columns(df, [("A", tiles)], accuracy=8, finish_rows=2)
    ordered = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0.0, r[0]))
    borders = last_ranks(len(rows), tiles)
    expected = {r[0]: 1 + sum(n > b for b in borders) for n, r in enumerate(ordered, 1)}
    found = df.select("CustomerID", columns["A", tiles].alias("tile")).collect()
    assert {r.CustomerID: r.tile for r in found} == expected
