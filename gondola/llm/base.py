"""What the corpus operators share: settled tables, text batches, numbers of partitions."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker unpacks at a time.
SLICE_BYTES = 2 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="gondola-llm-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """The folder that this application's intermediate tables are written to."""
    return f"{shared_folder(spark)}/llm/{spark.sparkContext.applicationId}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the application's folder in the shared one and read it again: it is computed
    once, its lineage ends and a lost executor takes nothing with it. Results are read from there,
    so the tables stay until ``discard``."""
    path = f"{run_folder(df.sparkSession)}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession) -> bool:
    """Delete what this application has settled. To be called when its results have been written or
    collected: those not yet read can't be any more. False if there was nothing."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``most`` bytes of ``column`` each (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


def raw(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def with_place(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__place``: (none, id, file, index), unique and in the order of doc_id, null
    last. File and row number stay the same however often and by whomever the table is read; a
    frame that isn't a file's is written first."""
    def placed(df: DataFrame) -> DataFrame:
        parts = (F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("index"))
        return df.select("*", F.struct(*parts).alias("__place"))

    try:
        return placed(docs)
    except AnalysisException:
        return placed(settle(docs, "documents"))
