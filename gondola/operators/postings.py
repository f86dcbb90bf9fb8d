"""Search by postings: which descriptions hold a run of three characters.

A table of descriptions and one of (gram, text) pairs are made once. A term's own grams are looked
up, texts that hold all of them are tested for the whole term, and only rows with such a
description are read of the product table. Terms of one or two characters are looked for in the
descriptions themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.functions.text import contains_ignore_case

GRAM = 3


def grams(text: Column, size: int = GRAM) -> Column:
    """The distinct runs of ``size`` characters of a text, whatever its case; none if shorter."""
    folded = F.lower(text)
    starts = F.when(F.length(folded) >= size, F.sequence(F.lit(1), F.length(folded) - (size - 1)))
    return F.coalesce(F.array_distinct(F.transform(starts, lambda i: F.substr(folded, i, F.lit(size)))), F.array().cast("array<string>"))


def description_postings(products: DataFrame, size: int = GRAM) -> DataFrame:
    """(grama, descripcion_producto): a row for each gram of each description. Store it sorted or
    partitioned by ``grama``, so that a search reads those of its term."""
    texts = products.select("descripcion_producto").where(F.col("descripcion_producto").isNotNull()).distinct()
    return texts.select(F.explode(grams(F.col("descripcion_producto"), size)).alias("grama"), "descripcion_producto")


def matching_descriptions(postings: DataFrame, descriptions: DataFrame, term: str, size: int = GRAM) -> DataFrame:
    """Descriptions that hold the term, whatever its case: through the grams if it has any."""
    lowered = term.lower()
    wanted = sorted({lowered[i : i + size] for i in range(len(lowered) - size + 1)})
    text = F.col("descripcion_producto")
    if not wanted:
        return descriptions.select(text).distinct().where(contains_ignore_case(text, term))
    holders = postings.where(F.col("grama").isin(wanted)).groupBy("descripcion_producto").agg(F.count_distinct("grama").alias("n"))
    return holders.where(F.col("n") == len(wanted)).select(text).where(contains_ignore_case(text, term))


def search_by_postings(products: DataFrame, postings: DataFrame, descriptions: DataFrame, term: str, brand: str | None = None) -> DataFrame:
    """The rows that ``search_products`` finds, by way of the postings."""
    if not term:
        return products.where(F.lit(False))
    found = products.join(matching_descriptions(postings, descriptions, term), "descripcion_producto", "left_semi").select(*products.columns)
    return found.where(F.col("marca") == brand) if brand else found
