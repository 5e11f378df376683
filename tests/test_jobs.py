"""Files in, whole analyses, files out."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from patronage import schema as S
from patronage import staging
from patronage.operators.cleaning import clean
from patronage.plans import jobs
from patronage.sources import tables
from patronage.sources.exports import CUSTOMERS_NAME, REPORT_NAME, report_header, report_lines
from patronage.sources.transactions import read_transactions

CSV = """InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country
536365,85123A,"HOLDER, WHITE",6,12/1/2010 8:26,2.55,17850,United Kingdom
C536379,D,Discount,-1,12/1/2010 9:41,27.5,14527,United Kingdom
536366,22633,WARMER,6,25/12/2010 8:28,1.85,17850.0,France
536367,22633,WARMER,6,2010-12-02 08:28:00,1.85,,France
"""


@pytest.fixture
def csv_path(tmp_path):
    path = tmp_path / "retail.csv"
    path.write_text(CSV)
    return str(path)


def test_columns_are_found_by_name(spark, csv_path):
    lines = read_transactions(spark, csv_path)
    assert lines.columns == list(S.TRANSACTION_TYPES)
    assert [lines.schema[c].dataType for c in lines.columns[:2]] == [
        S.TRANSACTION_TYPES["CustomerID"],
        S.TRANSACTION_TYPES["InvoiceNo"],
    ]
    rows = lines.collect()
    assert [r.CustomerID for r in rows] == [17850, 14527, 17850, None]
    assert rows[1].InvoiceNo == "C536379" and rows[1].Quantity == -1.0
    assert clean(lines).count() == 2


def test_inferred_types_clean_the_same(spark, csv_path):
    declared = clean(read_transactions(spark, csv_path))
    inferred = clean(read_transactions(spark, csv_path, infer=True))
    columns = [F.col("CustomerID").cast("bigint"), "InvoiceNo", "InvoiceDate", "TotalAmount"]
    assert sorted(declared.select(*columns).collect()) == sorted(
        inferred.select(*columns).collect()
    )


def test_text_ids(spark, tmp_path):
    path = tmp_path / "ids.csv"
    path.write_text(CSV.replace("17850,", "AB-1,"))
    lines = read_transactions(spark, str(path), customer_type="string")
    assert {r.CustomerID for r in lines.collect()} == {"AB-1", "14527", "17850.0", None}
    with pytest.raises(Exception):
        read_transactions(spark, str(path)).collect()
    table = jobs.rfm_only(lines).customers
    assert table.count() == 2


def test_missing_column_is_an_error(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("InvoiceNo,Quantity\n1,2\n")
    with pytest.raises(ValueError, match="CustomerID"):
        read_transactions(spark, str(path))


@pytest.fixture(scope="module")
def analysis(spark, small):
    return jobs.full_analysis(
        tables.lines(spark, small),
        invoices=tables.invoices(spark, small),
        cleaning=tables.cleaning_stats(spark, small),
        k=3,
        max_k=5,
        rules=S.SegmentRules().scale_money(1000),
    )


def test_full_analysis(analysis):
    customers, clusters = analysis.customers, analysis.clusters
    total = customers.kpis.first().customers
    assert total == customers.customers.count() == clusters.segmented.count()
    assert clusters.profile.agg(F.sum("CustomerID_count")).first()[0] == total
    assert clusters.impact.first().customers == total
    assert clusters.unscaled.first()[0] == 0
    assert customers.preview.count() == 10
    assert customers.cleaning.first().removed_count == 0
    assert clusters.elbow["table"].count() == 4 and clusters.elbow["pick"].count() == 1
    names = {r.Segment_Name for r in clusters.profile.collect()}
    assert {r.Segment for r in clusters.segmented.collect()} == names
    assert clusters.recommendations.count() == 3 * len(names)
    assert clusters.segmented.columns == [*S.SCORED_COLUMNS, "Segment"]
    assert customers.snapshot.first()[0] is not None
    for charts in (customers.charts, clusters.charts):
        for name in charts:
            assert charts[name].count() > 0
    cells = clusters.charts["cube_by_cluster"].agg(F.sum("customers")).first()[0]
    assert cells == total
    labels = [r.prediction for r in clusters.profile.collect()]
    assert labels == sorted(labels) == [r.prediction for r in clusters.summary.collect()]


def test_clustering_needs_no_description_first(spark, small, analysis):
    alone = jobs.clustering_only(tables.lines(spark, small), k=3, max_k=None)
    assert alone.elbow == {}
    assert alone.segmented.count() == analysis.clusters.segmented.count()


def test_customers_without_dates_are_scored_but_not_clustered(spark, small):
    lines = tables.lines(spark, small, dirty=True)
    hidden = F.when(F.col("CustomerID") % 10 == 0, "junk").otherwise(F.col("InvoiceDate"))
    result = jobs.full_analysis(lines.withColumn("InvoiceDate", hidden), k=2, max_k=None)
    undated = result.customers.customers.filter("Recency IS NULL").count()
    assert undated > 0
    assert result.clusters.unscaled.first()[0] == undated
    assert (
        result.clusters.segmented.count() + undated == result.customers.customers.count()
    )


def test_export_and_read_back(spark, analysis, tmp_path):
    written_at = dt.datetime(2024, 5, 6, 7, 8, 9)
    jobs.export(analysis.clusters, str(tmp_path), written_at=written_at)
    segmented = analysis.clusters.segmented
    back = spark.read.schema(segmented.schema).csv(f"{tmp_path}/{CUSTOMERS_NAME}", header=True)
    assert sorted(map(str, back.collect())) == sorted(map(str, segmented.collect()))
    lines = [r.value for r in spark.read.text(f"{tmp_path}/{REPORT_NAME}").collect()]
    total = segmented.count()
    assert lines[0] == f"Segments of {total} customers as of 2024-05-06 07:08:09"
    assert len(lines) == 4 + analysis.clusters.profile.count()
    first = analysis.clusters.summary.first()
    assert lines[4].split("\t")[:3] == [str(first.prediction), first.Segment_Name, str(first.customers)]


def test_report_numbers(spark):
    summary = spark.createDataFrame(
        [(n, "A", 1234, 10.04, 2.25, 1234.5, 1523373.0) for n in (1, 0)],
        "prediction int, Segment_Name string, customers bigint, Recency_mean double,"
        " Frequency_mean double, Monetary_mean double, revenue double",
    )
    header = report_header(dt.datetime(2024, 1, 2), 1234, 1, S.KMEANS_NAME, 0.48768)
    values = [r.value for r in report_lines(summary, header).collect()]
    assert header[1] == f"Model: {S.KMEANS_NAME} with k = 1, mean silhouette 0.4877"
    assert values[len(header) :] == [
        f"{n}\tA\t1234\t10.0\t2.3\t1234.50\t1523373" for n in (0, 1)
    ]


def test_ids_with_a_fraction_are_unknown(spark, tmp_path):
    path = tmp_path / "lines.csv"
    rows = ["17850.5,1,1/2/2011 8:00,1,2", "17850,2,1/2/2011 8:00,1,2", "17850.0,3,1/2/2011 8:00,1,2"]
    path.write_text("\n".join(["CustomerID,InvoiceNo,InvoiceDate,Quantity,UnitPrice", *rows]))
    found = {r.InvoiceNo: r.CustomerID for r in read_transactions(spark, str(path)).collect()}
    assert found == {"1": None, "2": 17850, "3": 17850}


def test_cells_that_are_no_numbers_are_counted_as_bad(spark, tmp_path):
    path = tmp_path / "lines.csv"
    rows = ["1,1,1/2/2011 8:00,NaN,2", "1,2,1/2/2011 8:00,1,Infinity", "1,3,1/2/2011 8:00,2,3", "1,4,1/2/2011 8:00,1e200,1e200"]
    path.write_text("\n".join(["CustomerID,InvoiceNo,InvoiceDate,Quantity,UnitPrice", *rows]))
    result = jobs.rfm_only(read_transactions(spark, str(path)))
    assert result.customers.first().Monetary == 6.0
    stats = result.cleaning.first()
    assert (stats.cleaned_count, stats.bad_quantity_count, stats.bad_price_count) == (1, 1, 1)


def test_nobody_to_cluster_is_a_clear_error(spark, small):
    with pytest.raises(ValueError, match="no customers"):
        jobs.clustering_only(tables.lines(spark, small).filter("Quantity < 0"), max_k=None)


def test_preview_shuffles_no_table(spark, small):
    rows = tables.first_lines(spark, small, dirty=True)
    assert rows.count() == 10
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = tables.first_lines(spark, small)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_a_scope_deletes_only_its_own_tables(spark):
    outside = staging.stage(spark.range(3).toDF("x"), "outside")
    with staging.scope(spark):
        inside = staging.stage(spark.range(3).toDF("x"), "inside")
        with staging.scope(spark):
            nested = staging.stage(spark.range(3).toDF("x"), "nested")
            assert nested.count() == 3
        assert inside.count() == 3
    assert outside.count() == 3
    with pytest.raises(Exception):
        inside.count()


def test_staging_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert staging.staging_root(spark) == named.rstrip("/")
    staged = staging.stage(spark.range(5).toDF("x"), "test")
    assert staged.count() == 5


def test_staged_tables_can_be_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "staging_root", lambda session: str(tmp_path))
    staging.stage(spark.range(5).toDF("x"), "first")
    staging.stage(spark.range(5).toDF("x"), "second")
    kept = tmp_path / "patronage" / "another-application"
    kept.mkdir()
    staging.drop_staged(spark)
    assert [p.name for p in (tmp_path / "patronage").iterdir()] == [kept.name]


class _Session:
    """A session on a cluster, or a local one, that names no folder."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.staging_root(_Session("yarn"))
    assert staging.staging_root(_Session("yarn", "hdfs://shared/")) == "hdfs://shared"
    local = _Session("local[2]")
    assert staging.staging_root(local) == local.folder
