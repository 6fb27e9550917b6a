"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="relaylens-")


def shared_folder(spark: SparkSession) -> str:
    """A new path under spark.checkpoint.dir; a folder of this machine only where that isn't set, as in local tests."""
    root = spark.conf.get("spark.checkpoint.dir", None) or _own_folder()
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def written(df):
    """df written to the shared folder and read back: later plans start from there."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def open_writers(spark: SparkSession, most: int):
    """Writes in here keep up to so many files open in a task, instead of sorting its rows by folder or bucket, which spills."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, most)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def dealt(df: DataFrame, buckets: int, by: str) -> DataFrame:
    """df written to the shared folder in buckets by a hash of a column and read back as a table whose buckets Spark knows.

    Grouping and joining it by that column needs no shuffle, however often; columns in files take about a third of what
    the same rows take in one shuffle.
    """
    spark, name = df.sparkSession, f"dealt_{uuid.uuid4().hex}"
    empty = spark.createDataFrame([], df.schema).coalesce(1)
    empty.write.format("parquet").bucketBy(buckets, by).option("compression", "zstd").option("path", shared_folder(spark)).saveAsTable(name)
    try:
        with open_writers(spark, buckets):
            df.write.insertInto(name)
        spark.catalog.refreshTable(name)
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # its files stay, and a plan that knows them needs no entry in the catalog
