"""One order and one customer that hold a third of all lines."""

import pytest
from pyspark.sql import functions as F

from patronage.operators.cleaning import clean
from patronage.operators.measures import customer_measures, invoice_facts
from patronage.sources import tables


@pytest.fixture(scope="module")
def skewed(spark, medium, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    items = spark.read.parquet(f"{medium}/lineitem.parquet").repartition(16)
    hot = F.when(F.col("l_partkey") % 3 == 0, F.lit(7)).otherwise(F.col("l_orderkey"))
    items.withColumn("l_orderkey", hot).write.parquet(f"{folder}/lineitem.parquet")
    orders = spark.read.parquet(f"{medium}/orders.parquet")
    orders.write.parquet(f"{folder}/orders.parquet")
    return folder


@pytest.fixture
def large_join(spark):
    """Settings under which these small tables are joined as large ones would be."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_order_is_split_between_tasks(spark, skewed, large_join):
    lines = tables.lines(spark, skewed)
    assert "skew=true" in _final_plan(lines)
    assert "skew=true" in _final_plan(customer_measures(invoice_facts(clean(lines))))


def test_early_sums_are_combined_before_they_are_shuffled(spark, skewed, large_join):
    plan = _final_plan(tables.invoices(spark, skewed))
    assert "skew=true" not in plan
    assert plan.count("partial_sum") >= 1


def test_hot_order_gives_whole_results(spark, skewed):
    late = customer_measures(invoice_facts(clean(tables.lines(spark, skewed))))
    early = customer_measures(tables.invoices(spark, skewed))
    assert late.exceptAll(early).count() == 0
    assert early.exceptAll(late).count() == 0
    total = spark.read.parquet(f"{skewed}/lineitem.parquet").count()
    assert early.agg(F.sum("TotalTransactions")).first()[0] == total
