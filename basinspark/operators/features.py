"""Standardisation, date split and the feature tables of training and forecasting."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinspark.functions.calendar import month_one_hot, month_start
from basinspark.operators.joins import strict_align
from basinspark.operators.shape import to_wide
from basinspark.schemas import FEATURES, PREDICTORS


@dataclass(frozen=True)
class Scaler:
    """Mean and population standard deviation per column; a constant column has scale 1."""

    means: dict[str, float]
    scales: dict[str, float]

    def scale(self, df: DataFrame, columns: Sequence[str] | None = None, suffix: str = "") -> DataFrame:
        return df.withColumns(
            {
                f"{column}{suffix}": (F.col(f"`{column}`") - F.lit(self.means[column])) / F.lit(self.scales[column])
                for column in columns or self.means
            }
        )

    def unscale(self, df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        return df.withColumns(
            {
                column: F.col(f"`{column}`") * F.lit(self.scales[column]) + F.lit(self.means[column])
                for column in columns or self.means
            }
        )

    def write(self, spark: SparkSession, path: str) -> None:
        rows = [(name, self.means[name], self.scales[name]) for name in self.means]
        spark.createDataFrame(rows, "name string, mean double, scale double").coalesce(1).write.parquet(path)

    @staticmethod
    def read(spark: SparkSession, path: str) -> Scaler:
        rows = spark.read.parquet(path).collect()  # one row per column
        return Scaler({r["name"]: r["mean"] for r in rows}, {r["name"]: r["scale"] for r in rows})


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> Scaler:
    """Fit on the given rows. One aggregate; its single row of moments is the fitted model."""
    moments = df.agg(
        *[F.avg(F.col(f"`{c}`")).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(F.col(f"`{c}`")).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    return Scaler(
        {c: float(moments[f"m{i}"] or 0.0) for i, c in enumerate(columns)},
        {c: float(moments[f"s{i}"] or 1.0) for i, c in enumerate(columns)},
    )


def date_split(
    df: DataFrame, column: str, train: tuple[str, str], test: tuple[str, str]
) -> tuple[DataFrame, DataFrame]:
    """Training and hold-out rows by date range, both ends included."""
    day = F.col(column)
    return (
        df.where(day.between(F.lit(train[0]).cast("date"), F.lit(train[1]).cast("date"))),
        df.where(day.between(F.lit(test[0]).cast("date"), F.lit(test[1]).cast("date"))),
    )


def feature_matrix(
    run_table: DataFrame, value: str = "value [mm]", predictors: Sequence[str] = tuple(PREDICTORS)
) -> DataFrame:
    """One row per run and month with the predictors and the month indicators in training order.

    Rows with a missing predictor are dropped.
    """
    named = run_table.withColumn(
        "_variable", F.concat("lake", F.lit("_"), "surface_type", F.lit("_"), "component")
    )
    wide = to_wide(named, ["cfs_run", "year", "month"], "_variable", predictors, value)
    indicators = FEATURES[len(PREDICTORS) :]
    return month_one_hot(wide, "month").select("cfs_run", "year", "month", *predictors, *indicators).na.drop("any")


def training_table(features: DataFrame, targets: DataFrame) -> DataFrame:
    """Features and targets of the same month with its date; a feature month without targets is an error."""
    return strict_align(features, targets, ["year", "month"]).withColumn(
        "month_start", month_start("year", "month")
    )
