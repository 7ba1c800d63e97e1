"""Selection of files by name, of object keys, and of links on index pages. Nothing is downloaded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basinspark.functions.names import name_part

# Parts of a page that carry no links, the link tag, and the character references in addresses.
HIDDEN_MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
LINK_TAG = r"(?i)<a\s[^>]*>"
LINK_TARGET = r"(?i)\shref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
CHARACTER_REFERENCES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def filter_names(df: DataFrame, column: str, affix: str, identifier: str) -> DataFrame:
    """Rows whose name begins or ends with ``identifier``; any other affix selects nothing."""
    name = F.col(column)
    tests = {"prefix": name.startswith(identifier), "suffix": name.endswith(identifier)}
    return df.where(tests.get(affix, F.lit(False)))


def filter_keys(df: DataFrame, column: str, product: str, suffix: str, prefix: str, out: str = "path") -> DataFrame:
    """Object keys that contain the product and end with the suffix, with their path below ``prefix``."""
    key = F.col(column)
    below = F.when(key.startswith(prefix), F.substring(key, F.lit(len(prefix) + 1), F.length(key))).otherwise(key)
    return df.where(key.contains(product) & key.endswith(suffix)).withColumn(out, below)


def select_run_files(df: DataFrame, column: str, product: str, run: str, suffix: str) -> DataFrame:
    """Files of one run, in name order."""
    name = F.col(column)
    return df.where(name.startswith(product + run) & name.endswith(suffix)).orderBy(name)


def name_fields(df: DataFrame, column: str, sep: str = ".", part: int = 3) -> DataFrame:
    """Forecast year and month from one part of a separated file name."""
    period = name_part(column, sep, part)
    return df.withColumns(
        {
            "forecast": period,
            "forecast_year": F.substring(period, 1, 4).cast("int"),
            "forecast_month": F.substring(period, 5, 2).cast("int"),
        }
    )


def link_targets(html: Column | str) -> Column:
    """Addresses of all links of a page, in page order, outside comments, scripts and styles."""
    html = F.col(html) if isinstance(html, str) else html
    tags = F.regexp_extract_all(F.regexp_replace(html, HIDDEN_MARKUP, ""), F.lit(LINK_TAG), 0)

    def target(tag: Column) -> Column:
        address = F.concat(*[F.regexp_extract(tag, LINK_TARGET, group) for group in (1, 2, 3)])
        for reference, character in CHARACTER_REFERENCES.items():
            address = F.replace(address, F.lit(reference), F.lit(character))
        return address

    return F.transform(F.filter(tags, lambda tag: tag.rlike(LINK_TARGET)), target)


def harvest_links(pages: DataFrame, html: str, base: Column | str, product: str, suffix: str) -> DataFrame:
    """One row per link whose address begins with ``product`` and ends with ``suffix``: full address and file name."""
    base = F.col(base) if isinstance(base, str) else base
    return (
        pages.withColumn("href", F.explode(link_targets(html)))
        .where(F.col("href").startswith(product) & F.col("href").endswith(suffix))
        .withColumns(
            {"file_url": F.concat(base, F.col("href")), "file_name": F.element_at(F.split("href", "/"), -1)}
        )
    )
