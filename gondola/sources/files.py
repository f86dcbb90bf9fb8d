"""Files and folders on whichever Hadoop file system holds them, and Parquet tables in them."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that ``spark.checkpoint.dir`` names; a temporary one only in local
    mode."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="gondola-")
    return f"{base.rstrip('/')}/{name}-{uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder on whichever Hadoop file system holds it; False if there was none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def missing_path(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_or_empty(spark: SparkSession, path: str | list[str], schema: T.StructType, **options) -> DataFrame:
    """Parquet table with a declared schema; an empty frame when there is no such path."""
    try:
        table = spark.read.schema(schema).options(**options).parquet(*([path] if isinstance(path, str) else path))
        return table.select(*schema.names)
    except AnalysisException as error:
        if missing_path(error):
            return spark.createDataFrame([], schema)
        raise


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a path on whichever Hadoop file system holds it; none if missing."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(folder))


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = file.getFileSystem(spark._jsc.hadoopConfiguration()).open(file)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small file."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = file.getFileSystem(spark._jsc.hadoopConfiguration()).create(file, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file; False if there is one of the new name. On HDFS one step; object stores without
    an atomic rename need a single writer."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    system = old.getFileSystem(spark._jsc.hadoopConfiguration())
    return not system.exists(new) and system.rename(old, new)


def write_by_date(
    df: DataFrame, path: str, order: Sequence[str] = (), whole: bool = False
) -> None:
    """Replace exactly the ``fecha`` partitions present in the frame; files are sorted.

    With ``whole`` the frame is the whole table: partitions it lacks are removed.

    Rebalancing lets adaptive execution size the files: small dates get one, a date that
    holds most of the rows is split over many tasks.
    """
    (
        df.hint("rebalance", "fecha")
        .sortWithinPartitions("fecha", *order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .option("compression", "snappy")
        .partitionBy("fecha")
        .parquet(path)
    )


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
