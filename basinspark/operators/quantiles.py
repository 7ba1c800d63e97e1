"""Exact medians and quantiles of groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basinspark.operators.groups import SMALL_GROUP
from basinspark.session import broadcast_if_small, persisted

_SERIES = "_series"
_VALUE = "_value"


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    probabilities: Mapping[str, float],
    small_group: int = SMALL_GROUP,
    accuracy: int = 10_000,
) -> DataFrame:
    """Quantiles with linear interpolation of several columns per group.

    ``probabilities`` maps a label to a probability; the result has the columns ``<column>_<label>``. NULL and NaN are
    left out, as are rows with a NULL key; a group without a value keeps its row, with NULL. Groups of up to
    ``small_group`` rows are sorted as arrays; in larger ones an approximate pass brackets the wanted ranks and only the
    values inside the brackets are ordered. Group sizes and brackets are computed when this is called.
    """
    numbers = df.na.drop(subset=list(keys)).select(*keys, *[_number(column).alias(column) for column in columns])
    if not keys:
        large = numbers.limit(small_group + 1).count() > small_group
        return (_by_brackets(numbers, None, keys, columns, probabilities, accuracy) if large else _by_sorted_arrays(numbers, keys, columns, probabilities))
    sizes = numbers.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    large_keys = persisted(sizes.where(F.col("_rows") > small_group).select(*keys))
    if large_keys.isEmpty():
        return _by_sorted_arrays(numbers, keys, columns, probabilities)
    side = broadcast_if_small(large_keys)
    small = _by_sorted_arrays(numbers.join(side, list(keys), "left_anti"), keys, columns, probabilities)
    return small.unionByName(_by_brackets(numbers.join(side, list(keys), "left_semi"), large_keys, keys, columns, probabilities, accuracy))


def _number(column: str) -> Column:
    value = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(value), value)


def _interpolated(low: Column, high: Column, rank: Column) -> Column:
    return low + (high - low) * (rank - F.floor(rank))


def _by_sorted_arrays(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], probabilities: Mapping[str, float]
) -> DataFrame:
    arrays = df.groupBy(*keys).agg(*[F.sort_array(F.collect_list(F.col(f"`{c}`"))).alias(c) for c in columns])

    def quantile(column: str, probability: float) -> Column:
        values = F.col(f"`{column}`")
        rank = F.lit(float(probability)) * (F.size(values) - 1)
        low, high = F.get(values, F.floor(rank).cast("int")), F.get(values, F.ceil(rank).cast("int"))
        return _interpolated(low, high, rank)

    return arrays.select(
        *keys, *[quantile(c, p).alias(f"{c}_{label}") for c in columns for label, p in probabilities.items()]
    )


def _by_brackets(
    df: DataFrame, groups: DataFrame | None, keys: Sequence[str], columns: Sequence[str], probabilities: Mapping[str, float], accuracy: int
) -> DataFrame:
    """Exact quantiles of large groups in two passes over the rows, neither of which sorts or copies them.

    The first pass merges approximate quantiles of the tasks, which give an interval that surely holds each wanted rank:
    an approximate quantile is off by at most 1 / ``accuracy`` of the rows, and the interval is wider than that on both
    sides. The second pass counts the rows below each interval, and the distinct values inside it with their rows; only
    those, a small share of a group, are put in order. A group without values gets NULL.
    """
    long = df.unpivot(list(keys), [f"`{c}`" for c in columns], _SERIES, _VALUE).where(F.col(_VALUE).isNotNull())
    group, margin = [*keys, _SERIES], 4 / accuracy
    labels = list(probabilities.items())
    sides = [(max(0.0, p - margin), min(1.0, p + margin)) for _, p in labels]
    marks = F.percentile_approx(_VALUE, [q for pair in sides for q in pair], accuracy)
    first = long.groupBy(*group).agg(F.count(F.lit(1)).alias("total"), marks.alias("_marks"))
    # An interval that reaches an end of the ranks has no bound there, nor has one that is not two rows wide on each side.
    wide = F.col("total") * margin >= 2
    low = [F.when(wide & F.lit(side[0] > 0), F.get("_marks", 2 * i)).otherwise(float("-inf")) for i, side in enumerate(sides)]
    high = [F.when(wide & F.lit(side[1] < 1), F.get("_marks", 2 * i + 1)).otherwise(float("inf")) for i, side in enumerate(sides)]
    brackets = persisted(first.select(*group, "total", F.array(*low).alias("_low"), F.array(*high).alias("_high")))
    bracketed = long.join(broadcast_if_small(brackets), group)

    # Rows below an interval, by label; a row inside one is counted by value.
    below = [F.count_if(F.col(_VALUE) < F.get("_low", i)).alias(f"_below_{i}") for i in range(len(labels))]
    inside = [
        F.when((F.col(_VALUE) >= F.get("_low", i)) & (F.col(_VALUE) <= F.get("_high", i)), F.lit(i)) for i in range(len(labels))
    ]
    hit = F.filter(F.array(*inside), lambda i: i.isNotNull())
    counts = bracketed.select(*group, "total", _VALUE, F.explode(hit).alias("_label")).groupBy(*group, "_label", _VALUE, "total").agg(F.count(F.lit(1)).alias("n"))
    under = bracketed.groupBy(*group).agg(*below).select(*group, F.posexplode(F.array(*[f"_below_{i}" for i in range(len(labels))])).alias("_label", "_under"))
    placed = counts.join(broadcast_if_small(persisted(under)), [*group, "_label"])
    ordered = Window.partitionBy(*group, "_label").orderBy(_VALUE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = placed.withColumn("before", F.col("_under") + F.sum("n").over(ordered) - F.col("n"))

    rank = F.get(F.array(*[F.lit(float(p)) for _, p in labels]), F.col("_label")) * (F.col("total") - 1)
    holds = lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("n"))
    picked = rows.groupBy(*group, "_label", "total").agg(
        F.max(F.when(holds(F.floor(rank)), F.col(_VALUE))).alias("_at"), F.max(F.when(holds(F.ceil(rank)), F.col(_VALUE))).alias("_next")
    )
    missed = F.raise_error(F.lit("An interval does not hold its rank.")).cast("double")
    value = _interpolated(F.coalesce("_at", missed), F.coalesce("_next", missed), rank)
    wide = picked.withColumn("_quantile", value).groupBy(*keys).agg(
        *[
            F.max(F.when((F.col(_SERIES) == column) & (F.col("_label") == i), F.col("_quantile"))).alias(f"{column}_{label}")
            for column in columns
            for i, (label, _) in enumerate(labels)
        ]
    )
    return wide if groups is None else groups.join(wide, list(keys), "left")
