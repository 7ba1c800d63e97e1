"""Ensemble statistics, forecast cut-off and lead tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basinspark.functions.calendar import month_index
from basinspark.functions.numbers import mean, rounded
from basinspark.operators.quantiles import exact_quantiles
from basinspark.session import broadcast_if_small, persisted


def forecast_cutoff(
    df: DataFrame, as_of: dt.date, day: int = 26, year: str = "year", month: str = "month"
) -> DataFrame:
    """Drop months that are past. From day ``day`` of the month on, the current month counts as past too."""
    first = as_of.year * 12 + as_of.month + (1 if as_of.day >= day else 0)
    # The year test repeats the month test in a form that reaches a table partitioned by year.
    return df.where((F.col(year) >= (first - 1) // 12) & (month_index(year, month) >= first))


def ensemble_mean(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str] | Mapping[str, str],
    digits: int | None = None,
) -> DataFrame:
    """Mean of each value column per group, every row with equal weight; rows with a NULL key are left out.

    ``values`` may map input columns to output names.
    """
    names = values if isinstance(values, Mapping) else {value: value for value in values}
    return (
        df.na.drop(subset=list(keys))
        .groupBy(*keys)
        .agg(*[rounded(mean(F.col(f"`{value}`")), digits).alias(out) for value, out in names.items()])
    )


def ensemble_median(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], digits: int | None = None
) -> DataFrame:
    """Exact median of each value column per group, under the column names of the input."""
    medians = exact_quantiles(df, keys, values, {"median": 0.5})
    return medians.select(
        *keys, *[rounded(F.col(f"`{value}_median`"), digits).alias(value) for value in values]
    )


def quantile_band(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], lower: float = 0.025, upper: float = 0.975
) -> DataFrame:
    """Band between two exact quantiles with linear interpolation: ``<value>_lower`` and ``<value>_upper``."""
    return exact_quantiles(df, keys, values, {"lower": lower, "upper": upper})


def numeric_means(df: DataFrame, keys: Sequence[str], exclude: Sequence[str] = ()) -> DataFrame:
    """Mean of every numeric column per group; other columns are left out."""
    numeric = [
        field.name
        for field in df.schema.fields
        if isinstance(field.dataType, T.NumericType) and field.name not in (*keys, *exclude)
    ]
    return ensemble_mean(df, keys, numeric)


def padded_range(df: DataFrame, by: Column, value: str, pad: float = 10.0, name: str = "series_group") -> DataFrame:
    """Lowest value minus and highest value plus a margin, per class of ``by``."""
    return df.groupBy(by.alias(name)).agg(
        (F.min(value) - pad).alias("range_low"), (F.max(value) + pad).alias("range_high")
    )


def tag_first_period(
    df: DataFrame, year: str, month: str, year_out: str = "current_year", month_out: str = "current_month"
) -> DataFrame:
    """Add the earliest (year, month) of the table to every row, as a scalar subquery."""
    first = df.agg(F.min(F.struct(F.col(year).alias("y"), F.col(month).alias("m"))).alias("first")).scalar()
    return df.withColumns({year_out: first["y"], month_out: first["m"]})


def lead_table(
    df: DataFrame,
    index: Sequence[str],
    year: str,
    month: str,
    value: str,
    horizon: int | None = None,
    prefix: str = "month_",
) -> DataFrame:
    """One column per forecast month in calendar order: ``month_1``, ``month_2``, …; repeated cells are averaged.

    Cells are averaged and written when this is called; what is pivoted, and the months that are ranked, come from them.
    A given ``horizon`` fixes the columns; more months than that are an error, so that none is left out.
    """
    cells = persisted(ensemble_mean(df, [*index, year, month], [value]))
    months = cells.select(year, month).distinct()
    ranked = broadcast_if_small(persisted(months.withColumn("_lead", F.dense_rank().over(Window.orderBy(year, month)))))
    found = ranked.count()
    if horizon is None:
        horizon = found
    elif found > horizon:
        raise ValueError(f"{found} months do not fit a horizon of {horizon}.")
    leads = cells.where(F.col(f"`{value}`").isNotNull()).join(ranked, [year, month])
    own = F.col(f"`{value}`")  # one row per cell, so that its value is the highest one
    return leads.groupBy(*index).agg(*[F.max(F.when(F.col("_lead") == k, own)).alias(f"{prefix}{k}") for k in range(1, horizon + 1)])


def first_leads(df: DataFrame, series: Sequence[str], order: Sequence[str], n: int = 8) -> DataFrame:
    """The first ``n`` rows of each series. Spark limits each series to ``n`` rows per task before the shuffle."""
    steps = Window.partitionBy(*series).orderBy(*order)
    return df.withColumn("lead", F.row_number().over(steps)).where(F.col("lead") <= n)


def union_models(predictions: Mapping[str, DataFrame], column: str = "model") -> DataFrame:
    """Stack the predictions of several models, each tagged with its name."""
    tagged = [df.withColumn(column, F.lit(name)) for name, df in predictions.items()]
    stacked = tagged[0]
    for df in tagged[1:]:
        stacked = stacked.unionByName(df)
    return stacked
