"""Shared-folder staging: cut lineage without relying on any executor staying alive."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def staging_root(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`, or the context's checkpoint folder.

    Only a local session without either gets a folder of its own; on a cluster a
    machine-local folder would not be visible to the executors, so that is an error.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="patronage-"))
    return context.getCheckpointDir()


_own: ContextVar[str] = ContextVar("own", default="")


def _application_folder(spark: SparkSession) -> str:
    """Where this application, or the scope it is in, stages tables."""
    return f"{staging_root(spark)}/patronage/{spark.sparkContext.applicationId}{_own.get()}"


def drop_staged(spark: SparkSession) -> None:
    """Delete every table this application, or the scope it is in, has staged.

    Only for when all results are consumed.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop(df: DataFrame) -> None:
    """Delete a table that `stage` returned, once nothing that is still to run reads it."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end, those of other analyses are not.

    Results must be consumed, or written elsewhere, before the scope ends.
    """
    before = _own.set(f"{_own.get()}/scope-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        drop_staged(spark)
        _own.reset(before)


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files, instead of keeping them until the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as Parquet to the shared folder and return a scan of it.

    Unlike a row checkpoint the scan is columnar, so later passes read only the columns
    they use, and unlike a cache it survives the loss of executors without going back to
    the source.
    """
    spark = df.sparkSession
    path = f"{_application_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
