"""Joins on month and run keys, strict alignment, and table comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basinspark.operators.positions import with_position
from basinspark.operators.shape import to_wide
from basinspark.session import size_checked


def attach_observed(
    forecasts: DataFrame, observations: Sequence[DataFrame], keys: Sequence[str], complete: bool = False
) -> DataFrame:
    """Left-join observation tables to forecasts; ``complete`` keeps only rows without missing values.

    Observations of monthly series are few, so the forecasts, whose months may be very unequal, are not shuffled.
    """
    joined = forecasts
    for observed in observations:
        joined = joined.join(size_checked(observed), list(keys), "left")
    return joined.na.drop("any") if complete else joined


def outer_series(
    series: Mapping[str, DataFrame], keys: Sequence[str], value: str, suffix: str = ""
) -> DataFrame:
    """Full outer join of several series on their key, one column per series.

    The series are stacked and pivoted, which is one shuffle for any number of them. A key must be unique per series.
    """
    stacked = [df.select(*keys, F.lit(name).alias("_series"), F.col(value).alias("_value")) for name, df in series.items()]
    long = reduce(lambda a, b: a.unionByName(b), stacked)
    columns = {f"{name}{suffix}": F.max(F.when(F.col("_series") == name, F.col("_value"))) for name in series}
    return long.groupBy(*keys).agg(*[column.alias(name) for name, column in columns.items()])


def aligned_columns(frames: Mapping[str, tuple[DataFrame, str]], keys: Sequence[str]) -> DataFrame:
    """One table from one column of each of several files, matched by key and never by row number.

    A key that is missing from one of the files is left out.
    """
    parts = [df.select(*keys, F.col(f"`{column}`").alias(out)) for out, (df, column) in frames.items()]
    return reduce(lambda a, b: a.join(b, list(keys)), parts)


def strict_align(features: DataFrame, targets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Targets for each feature key. A feature key without a target raises an error when its row is read."""
    marked = size_checked(targets.withColumn("_found", F.lit(True)))
    joined = features.join(marked, list(keys), "left")
    complaint = F.concat_ws(" ", F.lit("No target for"), *[F.col(key).cast("string") for key in keys])
    return joined.where(
        F.when(F.col("_found"), F.lit(True)).otherwise(F.raise_error(complaint).cast("boolean"))
    ).drop("_found")


def unmatched(features: DataFrame, targets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Feature keys without a target."""
    return features.select(*keys).join(targets.select(*keys), list(keys), "left_anti")


def _differs(a: str, b: str, columns: Sequence[str]) -> Column:
    return reduce(
        lambda x, y: x | y, [~F.col(f"{a}.{column}").eqNullSafe(F.col(f"{b}.{column}")) for column in columns]
    )


def compare_rows(frames: Mapping[str, DataFrame], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Row-by-row comparison of files on some columns, up to the shortest file.

    Rows are numbered from 1 in the order of ``order``. The result has one row per row number and pair of files that
    differ.
    """
    numbered = [
        with_position(df.select(*dict.fromkeys([*order, *columns])), order, "_at").select(
            "_at", F.struct(*columns).alias(name)
        )
        for name, df in frames.items()
    ]
    together = reduce(lambda a, b: a.join(b, "_at"), numbered)
    pairs = F.array_compact(
        F.array(
            *[F.when(_differs(a, b, columns), F.lit(f"{a} / {b}")) for a, b in combinations(frames, 2)]
        )
    )
    return together.select((F.col("_at") + 1).alias("row_number"), F.explode(pairs).alias("pair"))


def compare_keyed(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Comparison by key: keys on one side only, and keys whose values differ."""
    a = left.select(*keys, F.struct(*columns).alias("a"))
    b = right.select(*keys, F.struct(*columns).alias("b"))
    joined = a.join(b, list(keys), "full")
    status = (
        F.when(F.col("b").isNull(), "only in first")
        .when(F.col("a").isNull(), "only in second")
        .when(_differs("a", "b", columns), "differs")
    )
    return joined.select(*keys, status.alias("status")).where(F.col("status").isNotNull())


def obs_table(long: DataFrame, keys: Sequence[str], series: str, names: Sequence[str], value: str) -> DataFrame:
    """Wide observation table ``<name>_obs`` from long rows."""
    wide = to_wide(long, keys, series, names, value)
    return wide.select(*keys, *[F.col(f"`{name}`").alias(f"{name}_obs") for name in names])
