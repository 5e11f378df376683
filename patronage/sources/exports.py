"""Outputs: segmented customers and the summary report, and exports that are whole or not there.

A committed export is written beside its place, counted, given a manifest, and moved to its place in
one step. What has no manifest was never finished, so readers refuse it.
"""

from __future__ import annotations

import datetime
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.operators.clustering import Clustering

# Names of the exported files.
CUSTOMERS_NAME = "customer_segmentation_results.csv"
REPORT_NAME = "segmentation_summary.txt"


def write_customers(segmented: DataFrame, path: str, *, format: str = "csv") -> None:
    """Write one file per partition, with a header line when the format is CSV."""
    writer = segmented.write.mode("overwrite").format(format)
    if format == "csv":
        writer = writer.option("header", True)
    writer.save(path)


MANIFEST = "_manifest"


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def commit_export(df: DataFrame, path: str, *, format: str = "csv") -> dict:
    """Write `df` to `path`, replacing an earlier export only when the new one is complete.

    Returns the manifest: row count, columns with types in order, format. A run that ends early
    leaves a folder beside `path` that no reader takes for an export, and the earlier export as it
    was. Where the file system renames folders in one step, so does the last step.
    """
    spark = df.sparkSession
    files, place = _file_system(spark, path)
    beside = f"{path}.writing-{uuid.uuid4().hex}"
    write_customers(df, beside, format=format)
    written = spark.read.schema(df.schema).format(format)
    written = (written.option("header", True) if format == "csv" else written).load(beside)
    manifest = {
        "rows": written.count(),
        "columns": [[f.name, f.dataType.simpleString()] for f in df.schema.fields],
        "format": format,
    }
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.text(f"{beside}/{MANIFEST}")
    before = None
    if files.exists(place):
        before = _file_system(spark, f"{path}.before-{uuid.uuid4().hex}")[1]
        if not files.rename(place, before):
            raise OSError(f"cannot replace {path}")
    if not files.rename(_file_system(spark, beside)[1], place):
        if before is not None:
            files.rename(before, place)
        raise OSError(f"cannot move the export to {path}")
    if before is not None:
        files.delete(before, True)
    return manifest


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """A committed export, its columns in order and typed; an error if there is none that is whole."""
    files, place = _file_system(spark, f"{path}/{MANIFEST}/_SUCCESS")
    if not files.exists(place):
        raise FileNotFoundError(f"no finished export in {path}")
    manifest = json.loads(spark.read.text(f"{path}/{MANIFEST}").first()[0])
    schema = T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in manifest["columns"]))
    reader = spark.read.schema(schema).format(manifest["format"])
    if manifest["format"] == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    rows = reader.load(path)
    if rows.count() != manifest["rows"]:
        raise ValueError(f"{path} does not hold the {manifest['rows']} rows of its manifest")
    return rows


def report_header(
    written_at: datetime.datetime, customers: int, k: int, best_model: str, score: float | None
) -> list[str]:
    """The lines above the table."""
    quality = "not available" if score is None else f"{score:.4f}"
    return [
        f"Segments of {customers} customers as of {written_at.isoformat(sep=' ', timespec='seconds')}",
        f"Model: {best_model} with k = {k}, mean silhouette {quality}",
        "",
        "no.\tsegment\tsize\tdays since last invoice\tinvoices\tvalue\trevenue",
    ]


def report_lines(summary: DataFrame, header: list[str], key: str = "prediction") -> DataFrame:
    """The report as rows (section, line, value): the header, then a table row per group."""
    opening = summary.sparkSession.createDataFrame(
        [(-1, number, text) for number, text in enumerate(header)],
        "section int, line int, value string",
    )
    fields = (
        F.col(key).cast("string"),
        F.col("Segment_Name"),
        F.col("customers").cast("string"),
        F.format_string("%.1f", "Recency_mean"),
        F.format_string("%.1f", "Frequency_mean"),
        F.format_string("%.2f", "Monetary_mean"),
        F.format_string("%.0f", "revenue"),
    )
    table = summary.select(
        F.col(key).cast("int").alias("section"),
        F.lit(0).alias("line"),
        F.concat_ws("\t", *(F.coalesce(f, F.lit("-")) for f in fields)).alias("value"),
    )
    return opening.unionByName(table).orderBy("section", "line")


def write_report(
    summary: DataFrame,
    clustering: Clustering,
    k: int,
    path: str,
    *,
    written_at: datetime.datetime | None = None,
    key: str = "prediction",
) -> None:
    """Write the report as one text file; it has a line per cluster."""
    customers = summary.agg(F.sum("customers")).first()[0] or 0
    header = report_header(
        written_at or datetime.datetime.now(),
        customers,
        k,
        clustering.best_model,
        clustering.best_score,
    )
    lines = report_lines(summary, header, key)
    # One task sorts the lines it writes: merged partitions would keep no order.
    one = lines.repartition(1).sortWithinPartitions("section", "line")
    one.select("value").write.mode("overwrite").text(path)
