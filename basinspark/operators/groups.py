"""Telling small groups from large ones, so that each kind gets the plan that suits it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basinspark.session import broadcast_if_small, persisted

# A group up to this many rows is sorted within one task; a larger one is spread over several.
SMALL_GROUP = 100_000


def split_groups(
    df: DataFrame, keys: Sequence[str], rows: int = SMALL_GROUP
) -> tuple[DataFrame | None, DataFrame | None, DataFrame | None]:
    """The rows of groups with at most ``rows`` rows, the rows of larger groups, and the keys of those; None for what is empty.

    Keys must not be NULL. The sizes are one aggregate over the key columns, combined before its shuffle; it runs when
    this is called. The list of large groups has at most one entry per ``rows`` rows of the table, and its own size is
    checked before it is broadcast. If there are large groups the rows are written once, as all parts read them again.
    """
    if not keys:
        return (df, None, None) if df.limit(rows + 1).count() <= rows else (None, persisted(df), None)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    large = persisted(sizes.where(F.col("_rows") > rows).select(*keys))
    if large.isEmpty():
        return df, None, None
    df, side = persisted(df), broadcast_if_small(large)
    return df.join(side, list(keys), "left_anti"), df.join(side, list(keys), "left_semi"), large


def stacked(parts: Sequence[DataFrame | None]) -> DataFrame:
    """The parts that exist, one below the other."""
    present = [part for part in parts if part is not None]
    result = present[0]
    for part in present[1:]:
        result = result.unionByName(part)
    return result
