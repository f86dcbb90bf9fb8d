"""Store and chain attributes for price facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.functions.text import not_placeholder, strip
from gondola.operators.cleaning import strip_footer, trim_keys
from gondola.operators.joins import first_per_key
from gondola.settings import BLANK_KEYS, CHAIN_KEYS, PROVINCE_NAMES, STORE_KEYS


def prepare_dimension(
    dim: DataFrame, scope: Sequence[str] = (), order: Sequence[Column | str] = ("linea",)
) -> DataFrame:
    """Footer-free dimension with one row per key, the first one read."""
    tidy = trim_keys(strip_footer(dim))
    keys = [*scope, *[k for k in STORE_KEYS if k in tidy.columns]]
    return first_per_key(tidy, keys, order)


def _attach(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    scope: Sequence[str],
) -> DataFrame:
    """Left join to a dimension that is unique on its keys; facts never fan out.

    Making it unique ends in a shuffle, so adaptive execution knows its bytes: it broadcasts a
    small one, and splits the partitions of hot keys for a large one.
    """
    shared = [k for k in keys if k in facts.columns and k in dim.columns]
    if not shared:
        return facts
    # A column the facts already have wins over the dimension's.
    added = [c for c in dim.columns if c not in facts.columns]
    on = [*scope, *shared]
    return facts.join(dim.select(*on, *added), on, "left")


def enrich_stores(
    facts: DataFrame,
    stores: DataFrame,
    scope: Sequence[str] = (),
) -> DataFrame:
    """Left join the stores; ``scope`` names extra keys such as the archive they came in."""
    return _attach(facts, stores, STORE_KEYS, scope)


def enrich_chains(
    facts: DataFrame,
    chains: DataFrame,
    scope: Sequence[str] = (),
) -> DataFrame:
    return _attach(facts, chains, CHAIN_KEYS, scope)


def decode_province(
    df: DataFrame, code: str = "provincia_codigo", names: dict[str, str] | None = None
) -> DataFrame:
    """Province name of a code; unknown codes stand for themselves, blank ones are null."""
    if code not in df.columns:
        return df
    names = PROVINCE_NAMES if names is None else names
    lookup = F.create_map(*[F.lit(text) for pair in names.items() for text in pair])
    upper = F.upper(not_placeholder(strip(F.col(code)), BLANK_KEYS))
    return df.withColumn("provincia", F.coalesce(F.try_element_at(lookup, upper), upper))
