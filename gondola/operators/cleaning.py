"""Row-level cleaning of raw price records."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.functions.numbers import to_number
from gondola.functions.text import contains_folded, is_footer_key, not_placeholder, strip
from gondola.schemas import DOUBLE_COLUMNS, SILVER_COLUMNS, STRING_COLUMNS
from gondola.settings import NA_TOKENS, STORE_KEYS, Settings

Mapping = Sequence[tuple[str, str]]
PRICE_COLUMNS = ("precio_lista", "precio_referencia", "precio_promocion")


def _sources_by_name(mapping: Mapping) -> dict[str, list[str]]:
    sources: dict[str, list[str]] = {}
    for raw, canonical in mapping:
        sources.setdefault(canonical, []).append(raw)
    return sources


def clean_header(name: str) -> str:
    return name.replace("﻿", "").strip().lower()


def normalize_columns(df: DataFrame, mapping: Mapping) -> DataFrame:
    """Rename raw columns to canonical ones and drop the rest.

    Where several raw columns feed one name, the first of the mapping that exists wins,
    even if its values are null.
    """
    # Positions, because raw headers may repeat or differ only in case.
    positions: dict[str, int] = {}
    for position, name in enumerate(df.columns):
        positions.setdefault(clean_header(name), position)
    renamed = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    chosen = [
        F.col(f"_c{positions[raw]}").alias(canonical)
        for canonical, raws in _sources_by_name(mapping).items()
        for raw in [next((r for r in raws if r in positions), None)]
        if raw is not None
    ]
    return renamed.select(*chosen)


def resolve_layout(
    batches: DataFrame,
    mapping: Mapping,
    header: str = "encabezado",
    lines: str = "lineas",
    first_line: str = "primera_linea",
) -> DataFrame:
    """Line batches with their own headers -> one canonical record per line.

    The header is looked up once per batch, not per line. Lines with more fields than the
    header are dropped, missing trailing fields and NA tokens are null. A canonical column
    whose raw columns are all absent is null. Keeps the other columns and adds ``linea``.
    """
    keep = [c for c in batches.columns if c not in (header, lines, first_line)]
    names = F.transform(F.col(header), lambda h: F.lower(strip(F.replace(h, F.lit("﻿")))))
    sources = _sources_by_name(mapping)

    def position(raws: list[str]) -> Column:
        return F.coalesce(*[F.nullif(F.array_position("_names", r), F.lit(0)) for r in raws])

    located = batches.withColumn("_names", names).select(
        *keep,
        first_line,
        lines,
        F.size(header).alias("_width"),
        *[position(raws).cast("int").alias(f"_at_{name}") for name, raws in sources.items()],
    )
    records = located.select(
        *keep,
        first_line,
        "_width",
        *[f"_at_{name}" for name in sources],
        F.posexplode(lines).alias("_offset", "_fields"),
    ).where(F.size("_fields") <= F.col("_width"))

    def field(name: str) -> Column:
        value = F.get("_fields", F.col(f"_at_{name}") - 1)
        return F.when(~value.isin(*NA_TOKENS), value)

    return records.select(
        *keep,
        (F.col(first_line) + F.col("_offset")).alias("linea"),
        *[field(name).alias(name) for name in sources],
    )


def strip_footer(df: DataFrame, key: str = "id_comercio") -> DataFrame:
    """Drop the publisher's footer lines and blank lines."""
    return df.where(~is_footer_key(F.col(key))) if key in df.columns else df


def trim_keys(df: DataFrame, keys: Iterable[str] = STORE_KEYS) -> DataFrame:
    return df.withColumns({k: strip(F.col(k)) for k in keys if k in df.columns})


def price_in_band(price: Column, settings: Settings = Settings()) -> Column:
    """Null for a null price, which a filter takes as no."""
    return price.between(settings.min_price, settings.max_price)


def parse_prices(df: DataFrame) -> DataFrame:
    return df.withColumns({c: to_number(F.col(c)) for c in PRICE_COLUMNS if c in df.columns})


def clean_prices(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Prices as numbers; rows without a usable list price are dropped."""
    if "precio_lista" not in df.columns:
        return df.where(F.lit(False))
    return parse_prices(df).where(price_in_band(F.col("precio_lista"), settings))


def clean_strings(df: DataFrame) -> DataFrame:
    """Trim every text column of the contract and null its placeholders."""
    present = [c for c in STRING_COLUMNS if c in df.columns]
    # Two steps, so that the trimmed text is computed once and not per use.
    trimmed = df.withColumns({c: strip(F.col(c)) for c in present})
    return trimmed.withColumns({c: not_placeholder(F.col(c)) for c in present})


def in_category(df: DataFrame, keywords: Iterable[str]) -> Column:
    """Whether the category, or else the description, holds one of the keywords; true without both."""
    for column in ("rubro", "descripcion_producto"):
        if column in df.columns:
            return contains_folded(F.col(column), keywords)
    return F.lit(True)


def category_filter(df: DataFrame, keywords: Iterable[str]) -> DataFrame:
    return df.where(in_category(df, keywords))


def conform_silver(df: DataFrame, extra: Sequence[str] = ("fecha",)) -> DataFrame:
    """The Silver columns in order and type; absent ones are null."""

    def conformed(name: str) -> Column:
        if name not in df.columns:
            return F.lit(None).cast("double" if name in DOUBLE_COLUMNS else "string")
        if name not in DOUBLE_COLUMNS:
            return F.col(name).cast("string")
        if df.schema[name].dataType.typeName() == "string":
            return to_number(F.col(name))
        return F.col(name).cast("double")

    return df.select(
        *[conformed(c).alias(c) for c in SILVER_COLUMNS],
        *[c for c in extra if c in df.columns],
    )
