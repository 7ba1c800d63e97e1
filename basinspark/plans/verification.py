"""Forecasts against observations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinspark.functions.hydro import cms_to_mm
from basinspark.functions.names import recoded
from basinspark.operators.ensemble import numeric_means
from basinspark.operators.joins import attach_observed, obs_table
from basinspark.operators.skill import format_observed, skill_groups
from basinspark.schemas import (
    FEATURE_LAKES,
    MASK_LAKE_AREAS,
    POSTERIOR_OBSERVATIONS,
    RESIDUAL_OBSERVATIONS,
    SKILL_GROUPS,
    TARGETS,
)
from basinspark.sources.delimited import read_series

# Lake and component codes in the names of the observation files.
POSTERIOR_FILE = r"^(superior|erie|ontario|miHuron)(Evap|Precip|Runoff)_MonthlyRun\.csv$"
POSTERIOR_LAKES = {"superior": "superior", "erie": "erie", "ontario": "ontario", "miHuron": "michigan-huron"}
POSTERIOR_COMPONENTS = {"Evap": "evaporation", "Precip": "precipitation", "Runoff": "runoff"}
RESIDUAL_FILE = r"^Lake(Superior|Erie|Ontario|MichiganHuron)_MonthlyNetBasinSupply_.*\.csv$"
RESIDUAL_LAKES = {"Superior": "superior", "Erie": "erie", "Ontario": "ontario", "MichiganHuron": "michigan-huron"}


def _named(df: DataFrame, columns: Mapping[str, Mapping[str, str]]) -> DataFrame:
    return df.withColumns({column: recoded(column, table, "keep") for column, table in columns.items()})


def posterior_observations(spark: SparkSession, folder: str) -> DataFrame:
    """Long posterior medians of the component files of a folder: year, month, lake, component, observed."""
    raw = read_series(spark, folder, POSTERIOR_OBSERVATIONS, name_pattern=POSTERIOR_FILE, name_columns=("lake", "component"))
    known = raw.where(F.col("lake") != "")
    return _named(known, {"lake": POSTERIOR_LAKES, "component": POSTERIOR_COMPONENTS}).select(
        F.col("Year").cast("int").alias("year"),
        F.col("Month").cast("int").alias("month"),
        "lake",
        "component",
        F.col("Median").alias("observed"),
    )


def residual_observations(
    spark: SparkSession, folder: str, areas: Mapping[str, float] = MASK_LAKE_AREAS
) -> DataFrame:
    """Long residual net supply [mm] of the lake files of a folder, in the columns of the posterior observations."""
    raw = read_series(
        spark, folder, RESIDUAL_OBSERVATIONS, comment="#", name_pattern=RESIDUAL_FILE, name_columns=("lake",)
    )
    known = _named(raw.where(F.col("lake") != ""), {"lake": RESIDUAL_LAKES})
    long = format_observed(known, ids=["lake"]).select(
        F.year("month_start").alias("year"), F.month("month_start").alias("month"), "lake", "observed"
    )
    return long.select(
        "year",
        "month",
        "lake",
        F.lit("cnbs").alias("component"),
        cms_to_mm("observed", "lake", "year", "month", areas).alias("observed"),
    )


def verify(
    predictions: DataFrame, observations: DataFrame, scaling: str = "obs_raw", digits: int | None = 3
) -> DataFrame:
    """Skill of every model and group, from wide predictions and long observations.

    Predictions are averaged per month and model, and only months with every prediction and observation count.
    """
    monthly = numeric_means(predictions, ["year", "month", "model"], exclude=["cfs_run"])
    named = observations.withColumn("_series", F.concat("lake", F.lit("_"), "component"))
    wide = obs_table(named, ["year", "month"], "_series", TARGETS, "observed")
    combined = attach_observed(monthly, [wide], ["year", "month"], complete=True)
    groups = {
        name: [f"{lake}_{component}" for lake in FEATURE_LAKES for component in components]
        for name, components in SKILL_GROUPS.items()
    }
    pairs = {target: (target, f"{target}_obs") for target in TARGETS}
    return skill_groups(combined, pairs, groups, ["model"], scaling, digits)
