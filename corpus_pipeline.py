"""Documents to training sequences: five stages, each written as Parquet and read again.

Every stage works on all rows its predecessor kept. All but the last return the columns of
``documents``. Rows are told apart by file and row number, so that repeated or null doc_ids are
kept and dropped row by row.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.llm import exact_dedup, language, near_texts, packing, pii, simhash
from gondola.llm.base import settle, with_place
from gondola.llm.components import components


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter (``und``), null and empty texts among them, and no others:
    shares are relative to the learned languages, so that a text in another language of a learned
    script, or gibberish, stays. Nulls in other columns don't matter."""
    model = language.learn(docs.where(~language.held_out()))
    found = language.predict(docs, model, docs.columns, ("__lang", "__share", "__spans"))
    return found.where(F.col("__lang") != "und").select(*quoted(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of texts that are equal but for white space."""
    placed = with_place(docs)
    found = exact_dedup.find_copies(placed.select(F.col("__place").alias("doc_id"), "text"))
    return only(docs, placed, found.where("kept").select("doc_id"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near copies the row with the smallest doc_id. Texts are linked by
    fingerprints that differ in four bits or fewer (op7's operator), and by four fifths of their
    five-word shingles in common, which such fingerprints may miss; a group is what links of either
    kind connect, through any number of others."""
    placed = with_place(docs)
    rows = placed.select(F.col("__place").alias("doc_id"), "text")
    alike = simhash.near_components(rows).select("doc_id", "component_id")
    links = alike.unionByName(near_texts.near_text_components(rows)).select(F.col("doc_id").alias("a"), F.col("component_id").alias("b"))
    return only(docs, placed, components(links).where("node <> component").select(F.col("node").alias("doc_id")), "left_anti")


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data and secrets; keeps every row."""
    return pii.replace_private(docs, pii.surrogate_key(spark)).select(*quoted(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs every document into sequences of 2048 tokens: one row for each piece."""
    packed = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def quoted(docs: DataFrame) -> list:
    return [F.col(f"`{n}`") for n in docs.columns]


def only(docs: DataFrame, placed: DataFrame, places: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of ``docs`` at the given places, or those elsewhere (``left_anti``)."""
    at = places.select(F.col("doc_id.file").alias("__file"), F.col("doc_id.index").alias("__index"))
    rows = placed.withColumns({"__file": F.col("__place.file"), "__index": F.col("__place.index")})
    return rows.join(at, ["__file", "__index"], how).select(*quoted(docs))


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("private", replace_private),
    ("packing", pack),
]

#: Models, hashes and tokenizers aren't SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
