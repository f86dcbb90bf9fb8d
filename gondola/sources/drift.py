"""Parquet folders whose files were written with other columns or types than the declared ones."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from gondola.sources.files import missing_path, read_or_empty


def _footers(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from gondola.sources.archive import _open_fs

    for frame in frames:
        schemas = []
        for path in frame["path"]:
            filesystem, name = _open_fs(path)
            with filesystem.open_input_file(name) as file:
                schemas.append(from_arrow_schema(pq.read_schema(file)).json())
        yield frame.assign(schema=schemas)


def physical_schemas(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, schema) of every Parquet file below some folders: names are listed by the driver,
    footers read by tasks, contents by nobody."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(list(paths))
    return files.select("path").repartition(spark.sparkContext.defaultParallelism, "path").mapInPandas(_footers, "path string, schema string")


def read_drifted(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, **options) -> DataFrame:
    """Like ``read_or_empty``, where files may hold a declared column as another type: it is cast,
    and what can't be cast is null, as absent columns are.

    Files are put together by the types that their footers name, each such group is read at once
    with one cast, and the groups are united: as many scans as there are ways to write the table.
    Without drift that is one, and filters reach it as they are.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    declared = {f.name: f.dataType for f in schema}
    try:
        # Partitions written alike are one row; paths are as many as Spark itself would list.
        found = physical_schemas(spark, paths).groupBy("schema").agg(F.collect_list("path").alias("paths")).collect()
    except AnalysisException as error:
        if missing_path(error):
            return spark.createDataFrame([], schema)
        raise
    groups: dict[str, tuple[dict, list[str]]] = {}
    for row in found:
        stored = {f.name: f.dataType for f in T.StructType.fromJson(json.loads(row.schema))}
        other = {n: t for n, t in stored.items() if n in declared and t != declared[n]}
        key = json.dumps({n: t.json() for n, t in other.items()}, sort_keys=True)
        groups.setdefault(key, (other, []))[1].extend(row.paths)
    frames = []
    for _, (other, files) in sorted(groups.items()):
        stored = T.StructType([T.StructField(f.name, other.get(f.name, f.dataType)) for f in schema])
        read = read_or_empty(spark, sorted(files), stored, **options)
        frames.append(read.select(*(F.col(n).try_cast(declared[n]).alias(n) if n in other else F.col(n) for n in schema.names)))
    if not frames:
        return spark.createDataFrame([], schema)
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole
