"""Lake tables: layout, readers and writers.

Layout under one root (any Hadoop file system): ``bronze/<tipo>/fecha=…/*.zip``,
``silver/<tipo>/_quality/fecha=…/*.json``, and the published tables ``silver/<tipo>/precios`` and
``gold/<tipo>/<table>``, whose valid folders a manifest names (see ``published.py``).
"""

from __future__ import annotations

import datetime as dt
import logging
import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.operators.report import rounded
from gondola.schemas import GOLD, PRODUCT_LABELS, PRODUCT_SETS, QUALITY_REPORT, SILVER
from gondola.sources.drift import read_drifted
from gondola.sources.files import delete_folder, list_names, missing_path
from gondola.sources.published import Published

logger = logging.getLogger(__name__)
_FOLDER = re.compile(r"fecha=(\d{4}-\d{2}-\d{2})")


@dataclass(frozen=True)
class Lake:
    root: str

    def bronze(self, tipo: str) -> str:
        return f"{self.root}/bronze/{tipo}"

    def silver_root(self, tipo: str) -> str:
        return f"{self.root}/silver/{tipo}"

    def silver(self, tipo: str) -> str:
        return f"{self.silver_root(tipo)}/precios"

    def quality(self, tipo: str) -> str:
        return f"{self.root}/silver/{tipo}/_quality"

    def gold_root(self, tipo: str) -> str:
        return f"{self.root}/gold/{tipo}"

    def gold(self, tipo: str, table: str) -> str:
        return f"{self.gold_root(tipo)}/{table}"

    def staging(self, name: str) -> str:
        """Folder for an intermediate table, on the lake's own file system."""
        return f"{self.root}/_staging/{name}"


def drop_dates(spark: SparkSession, path: str, dates: Iterable[dt.date]) -> list[dt.date]:
    """Delete the listed ``fecha`` folders of a raw area, as planned by the retention plan."""
    return [d for d in sorted(dates) if delete_folder(spark, f"{path}/fecha={d.isoformat()}")]


def stored_dates(spark: SparkSession, path: str) -> DataFrame:
    """Dates that have a folder under a partitioned path, ascending: one listing, one level."""
    named = (_FOLDER.fullmatch(name) for name in list_names(spark, path))
    dates = {dt.date.fromisoformat(found[1]) for found in named if found}
    return spark.createDataFrame([(d,) for d in sorted(dates)], "fecha date")


def silver_scan(silver: DataFrame) -> DataFrame:
    """Facts with a price; partitions written without some column read it as null."""
    return silver.where(F.col("precio_lista").isNotNull())


def read_silver(spark: SparkSession, lake: Lake, tipo: str, dates: Iterable[dt.date] | None = None) -> DataFrame:
    # Partitions that other programs wrote may lack columns or hold them as other types.
    return silver_scan(Published(spark, lake.silver_root(tipo)).read("precios", SILVER, dates, read_drifted))


def load_gold(spark: SparkSession, lake: Lake, tipo: str) -> dict[str, DataFrame]:
    """The four tables of one state: never some from before a refresh and some from after it."""
    tables = Published(spark, lake.gold_root(tipo))
    return {name: tables.read(name, schema) for name, schema in GOLD.items()}


def load_labels(spark: SparkSession, lake: Lake, tipo: str) -> DataFrame:
    """The description shown for each product id, so that questions about two dates read no more."""
    return Published(spark, lake.gold_root(tipo)).read("product_labels", PRODUCT_LABELS)


def load_sets(spark: SparkSession, lake: Lake, tipo: str) -> DataFrame:
    """Each date's products as foldable bitmaps, for distinct counts over any dates."""
    return Published(spark, lake.gold_root(tipo)).read("product_sets", PRODUCT_SETS)


def published_dates(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Valid dates of a published table, ascending."""
    return spark.createDataFrame([(d,) for d in Published(spark, root).dates(table)], "fecha date")


def load_quality(spark: SparkSession, lake: Lake, tipo: str) -> DataFrame:
    """All run reports; unreadable files are dropped, no files give an empty frame."""
    try:
        reports = (
            spark.read.schema(QUALITY_REPORT)
            .option("mode", "DROPMALFORMED")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.json")
            .json(lake.quality(tipo))
        )
    except AnalysisException as error:
        if not missing_path(error):
            raise
        reports = spark.createDataFrame([], QUALITY_REPORT)
    return reports.where(F.col("date").isNotNull())


def write_quality(report: DataFrame, lake: Lake, tipo: str) -> bool:
    """One small JSON file per (tipo, fecha). Failing to report never fails a run."""
    try:
        (
            report.where(F.col("tipo") == tipo)
            .withColumn("fecha", F.to_date("date"))
            .coalesce(1)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("fecha")
            .json(lake.quality(tipo))
        )
    except Exception:  # noqa: BLE001
        logger.warning("could not write the quality report of %s", tipo, exc_info=True)
        return False
    return True


def write_csv(df: DataFrame, path: str) -> None:
    """CSV export with a header; floating-point columns rounded to two decimals."""
    rounded(df).write.mode("overwrite").option("header", True).csv(path)
