"""Publisher's catalogue: JSON package and web page."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.functions.dates import iso_timestamp, weekday_slug
from gondola.schemas import CATALOGUE_PACKAGE
from gondola.settings import WEEKDAY_SLUGS

# Fixed value: archive links end in the weekday's name.
_ARCHIVE_LINK = r"(?i)sepa_([a-z]+)\.zip$"
# Values in double quotes, in single quotes, or bare; ``data-href`` and the like are other attributes.
_HREF = r"""(?i)<a(?:\s+|\s[^>]*?\s)href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def catalogue_resources(packages: DataFrame, json: str = "paquete") -> DataFrame:
    """(tipo, JSON package) -> weekday archives: tipo, posicion, slug, url, last_modified, name."""
    resources = (
        packages.withColumn("_package", F.from_json(json, CATALOGUE_PACKAGE))
        .where(F.col("_package.success"))
        .select("tipo", F.posexplode("_package.result.resources").alias("posicion", "_r"))
    )
    # An empty text counts as absent.
    stamp = F.coalesce(F.nullif("_r.last_modified", F.lit("")), F.col("_r.created"))
    return resources.select(
        "tipo",
        "posicion",
        F.lower(F.regexp_extract("_r.url", _ARCHIVE_LINK, 1)).alias("slug"),
        F.col("_r.url").alias("url"),
        iso_timestamp(stamp).alias("last_modified"),
        F.col("_r.name").alias("name"),
    ).where(F.col("slug").isin(*WEEKDAY_SLUGS))


def available_dates(resources: DataFrame) -> DataFrame:
    """Distinct dates the publisher offers per tipo."""
    return (
        resources.select("tipo", F.to_date("last_modified").alias("fecha"))
        .where(F.col("fecha").isNotNull())
        .distinct()
    )


def page_links(html: Column) -> Column:
    """All link targets of a page in order."""
    found = [F.regexp_extract_all(html, F.lit(_HREF), F.lit(k)) for k in (1, 2, 3)]
    either = lambda a, b: F.concat(a, b)
    one = F.zip_with(found[0], F.zip_with(found[1], found[2], either), either)
    return F.transform(one, lambda href: F.replace(href, F.lit("&amp;"), F.lit("&")))


def first_link(html: Column, pattern: str | Column, base: str | Column) -> Column:
    """First link target matching a pattern; site-relative ones get the base url."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    matching = F.filter(page_links(html), lambda href: F.rlike(href, pattern))
    href = F.get(matching, F.lit(0))
    base = F.lit(base) if isinstance(base, str) else base
    return F.when(href.startswith("/"), F.concat(base, href)).otherwise(href)


def archive_link(html: Column, day: dt.date | Column, base: str | Column) -> Column:
    """Link to the archive of a date's weekday, null if the page has none."""
    slug = weekday_slug(day) if isinstance(day, Column) else F.lit(WEEKDAY_SLUGS[day.weekday()])
    return first_link(html, F.concat(F.lit("(?i)sepa_"), slug, F.lit(r"\.zip$")), base)
