"""From the run table to published forecast tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basinspark.functions.hydro import mm_to_cms
from basinspark.operators.ensemble import (
    ensemble_mean,
    ensemble_median,
    forecast_cutoff,
    lead_table,
    tag_first_period,
)
from basinspark.operators.features import feature_matrix
from basinspark.operators.models import Ensemble
from basinspark.operators.shape import split_composite, to_long
from basinspark.schemas import LAKE_AREAS
from basinspark.session import persisted
from basinspark.sources.delimited import write_tsv
from basinspark.sources.tables import append

MM, CMS = "value [mm]", "value [cms]"
GROUP = ["year", "month", "lake", "component"]


def ensemble_rows(predictions: DataFrame, targets: list[str], areas: Mapping[str, float] = LAKE_AREAS) -> DataFrame:
    """Wide predictions to one row per run, month, model, lake and component in both units."""
    ids = ["cfs_run", "month", "year", "model"]
    long = split_composite(to_long(predictions, ids, targets, "_name", MM), "_name", ["lake", "component"])
    return long.withColumn(CMS, mm_to_cms(F.col(f"`{MM}`"), "lake", "year", "month", areas)).select(
        *ids, "lake", "component", MM, CMS
    )


def published(rows: DataFrame, digits: int | None = 3) -> DataFrame:
    """Grand ensemble mean per forecast month, tagged with the first month of the forecast."""
    means = ensemble_mean(rows, GROUP, [MM, CMS], digits).withColumnsRenamed(
        {"year": "forecast_year", "month": "forecast_month"}
    )
    return tag_first_period(means, "forecast_year", "forecast_month").select(
        "current_year", "current_month", "forecast_year", "forecast_month", "lake", "component", MM, CMS
    )


def published_by_lead(table: DataFrame, value: str = CMS, horizon: int | None = None) -> DataFrame:
    """Published forecast with one column per lead month."""
    return lead_table(
        table,
        ["current_year", "current_month", "lake", "component"],
        "forecast_year",
        "forecast_month",
        value,
        horizon,
    )


@dataclass(frozen=True)
class ForecastTables:
    rows: DataFrame
    model_mean: DataFrame
    model_median: DataFrame
    published: DataFrame

    def write(self, folder: str) -> None:
        append(self.rows, f"{folder}/cnbs_forecast")
        append(self.model_mean, f"{folder}/cnbs_forecast_model_mean")
        append(self.model_median, f"{folder}/cnbs_forecast_model_median")
        write_tsv(self.published.orderBy("forecast_year", "forecast_month", "lake", "component"), f"{folder}/published")


def forecast(run_table: DataFrame, ensemble: Ensemble, as_of: dt.date | None) -> ForecastTables:
    """All forecast tables; without ``as_of`` past months are kept, as verification needs them.

    The cut-off is applied to the run table, before the pivot.
    """
    current = run_table if as_of is None else forecast_cutoff(run_table, as_of)
    predictions = ensemble.predict_all(feature_matrix(current), ["cfs_run", "year", "month"])
    # Written once, as every summary reads it and the models should score once.
    rows = persisted(ensemble_rows(predictions, ensemble.targets))
    by_model = ["year", "month", "model", "lake", "component"]
    return ForecastTables(
        rows,
        ensemble_mean(rows, by_model, [MM, CMS], 3),
        ensemble_median(rows, by_model, [MM, CMS], 3),
        published(rows),
    )
