"""Date formats, filters and counts on hand-made lines."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage import schema as S
from patronage.functions.scalars import date_shape, parse_invoice_date
from patronage.operators.cleaning import clean, cleaning_stats, preview
from patronage.sources import tables

LINES = "CustomerID bigint, InvoiceNo string, InvoiceDate string, Quantity double, UnitPrice double"
GOOD_DATE = "12/1/2010 8:26"


def frame(spark, *rows):
    return spark.createDataFrame(rows, LINES)


def test_dates_in_three_formats(spark):
    expected = {
        "12/1/2010 8:26": dt.datetime(2010, 12, 1, 8, 26),
        "25/3/2011 17:05": dt.datetime(2011, 3, 25, 17, 5),
        "3/4/2011 9:00": dt.datetime(2011, 3, 4, 9, 0),
        "2011-12-09 12:50:00": dt.datetime(2011, 12, 9, 12, 50),
        "not a date": None,
        None: None,
    }
    lines = frame(spark, *((1, "A", text, 1.0, 1.0) for text in expected))
    parsed = clean(lines).select(F.date_format("InvoiceDate", "yyyy-MM-dd HH:mm").alias("d"))
    wanted = [value and value.strftime("%Y-%m-%d %H:%M") for value in expected.values()]
    assert sorted(str(r.d) for r in parsed.collect()) == sorted(map(str, wanted))


def test_shape_test_never_hides_a_readable_date(spark):
    numbers = ["0", "1", "01", "001", "2", "9", "12", "13", "29", "30", "31", "32", "-1", "+5", ""]
    texts = [f"{a}/{b}/2011 9:05" for a in numbers for b in numbers]
    texts += [f"3/4/{y} 9:05" for y in ("11", "211", "2011", "+2011", "12011", "+12011", "-2011")]
    texts += [f"3/4/2011 {h}:{m}" for h in numbers for m in ("5", "05", "59", "60", "005")]
    texts += [f"2011-{a}-{b} 09:05:00" for a in numbers for b in ("1", "01", "30", "31")]
    texts += [f"2011-03-04 {h}:05:{s}" for h in ("9", "09", "23", "24") for s in ("0", "00", "60")]
    texts += [" 3/4/2011 9:05", "3/4/2011 9:05 ", "3/4/2011  9:05", "3-4-2011 9:05", "٣/4/2011 9:05"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    plain = F.coalesce(*(F.try_to_timestamp("s", F.lit(f)) for f in S.DATE_FORMATS))
    guarded = parse_invoice_date("s", T.StringType())
    differing = df.select("s", plain.alias("a"), guarded.alias("b")).filter("NOT a <=> b")
    assert differing.collect() == []
    assert df.filter(plain.isNotNull()).count() > 50


def test_unusual_formats_are_left_to_the_parser():
    assert date_shape("yyyyMMdd") is None
    assert date_shape("MMM d, yyyy") is None
    assert date_shape("yyyy-MM-dd'T'HH:mm") is None


def test_timestamp_column_passes_through(spark):
    df = spark.sql(
        "SELECT 1L CustomerID, 'A' InvoiceNo, timestamp'2011-05-06 07:08:09' InvoiceDate,"
        " 2D Quantity, 0.335D UnitPrice"
    )
    row = clean(df).first()
    assert row.InvoiceDate == dt.datetime(2011, 5, 6, 7, 8, 9)
    assert row.TotalAmount == 0.67


def test_filters_and_counts(spark):
    lines = frame(
        spark,
        (1, "A", GOOD_DATE, 2.0, 1.5),
        (None, "A", GOOD_DATE, 2.0, 1.5),
        (1, "A", GOOD_DATE, 0.0, 1.5),
        (1, "A", GOOD_DATE, -1.0, 1.5),
        (1, "A", GOOD_DATE, None, 1.5),
        (1, "A", GOOD_DATE, 2.0, 0.0),
        (1, "A", GOOD_DATE, 2.0, None),
        (2, "B", "junk", 1.0, 1.0),
    )
    assert clean(lines).count() == 2
    assert clean(lines, on_bad_date="drop").count() == 1
    stats = cleaning_stats(lines).first()
    assert (stats.original_count, stats.cleaned_count, stats.removed_count) == (8, 2, 6)
    assert stats.retention_rate == 25.0
    assert stats.unknown_customer_count == 1
    assert stats.bad_quantity_count == 3
    assert stats.bad_price_count == 2
    assert stats.bad_date_count == 1
    assert cleaning_stats(lines, on_bad_date="drop").first().cleaned_count == 1
    with pytest.raises(ValueError):
        clean(lines, on_bad_date="guess")


def test_empty_input(spark):
    lines = frame(spark)
    assert clean(lines).count() == 0
    stats = cleaning_stats(lines).first()
    assert (stats.original_count, stats.retention_rate) == (0, 0.0)


def test_preview_is_repeatable(spark, medium):
    cleaned = clean(tables.lines(spark, medium))
    first = preview(cleaned).collect()
    assert len(first) == 10
    assert preview(cleaned.repartition(7)).collect() == first


def test_filters_reach_the_scan(spark, medium):
    plan = tables.invoices(spark, medium)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,0.0)" in plan
    assert "l_comment" not in plan and "o_totalprice" not in plan


@pytest.mark.parametrize("on_bad_date", ["keep", "drop"])
@pytest.mark.parametrize("dirty", [False, True])
def test_counts_before_the_join_equal_counts_after(spark, small, dirty, on_bad_date):
    early = tables.cleaning_stats(spark, small, dirty=dirty, on_bad_date=on_bad_date)
    late = cleaning_stats(tables.lines(spark, small, dirty=dirty), on_bad_date=on_bad_date)
    assert early.collect() == late.collect()
