"""End-to-end flows over the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basinspark.catalog import query
from basinspark.catalog.inputs import LINE_CENTS, LINE_MONTH, ORDER_CENTS, ORDER_MONTH, line_months, order_months
from basinspark.functions.numbers import mean
from basinspark.operators import models
from basinspark.operators.ensemble import forecast_cutoff
from basinspark.operators.features import feature_matrix, fit_scaler, training_table
from basinspark.operators.shape import to_wide
from basinspark.plans.forecast import ensemble_rows, forecast, published, published_by_lead
from basinspark.plans.training import train
from basinspark.plans.verification import verify
from basinspark.session import persisted
from basinspark.schemas import (
    FEATURE_LAKES,
    FEATURES,
    PREDICTOR_COMPONENTS,
    SURFACES,
    TARGET_COMPONENTS,
    TARGETS,
)

AS_OF = dt.date(2001, 2, 26)


def _pick(names: list[str], number: Column) -> Column:
    return F.get(F.array(*[F.lit(name) for name in names]), (number % len(names)).cast("int"))


def _observed(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as long monthly observations of four lakes and four components."""
    named = order_months(spark, folder).withColumns(
        {
            "lake": _pick(FEATURE_LAKES, F.col("o_custkey")),
            "component": _pick(TARGET_COMPONENTS, F.col("o_orderkey")),
        }
    )
    return named.groupBy("year", "month", "lake", "component").agg((mean("cents") / 1e6).alias("observed"))


def _targets(spark: SparkSession, folder: str) -> DataFrame:
    named = _observed(spark, folder).withColumn("name", F.concat("lake", F.lit("_"), "component"))
    return to_wide(named, ["year", "month"], "name", TARGETS, "observed").na.drop("any")


def _predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as wide predictions of two models and five runs."""
    named = line_months(spark, folder).withColumns(
        {
            "model": F.col("l_linestatus"),
            "cfs_run": F.col("l_suppkey") % 5,
            "name": F.concat(
                _pick(FEATURE_LAKES, F.col("l_linenumber")), F.lit("_"), _pick(TARGET_COMPONENTS, F.col("l_partkey"))
            ),
            "value": F.col("l_extendedprice") / 1000,
        }
    )
    keys = ["cfs_run", "year", "month", "model"]
    cells = named.groupBy(*keys, "name").agg((mean("cents") / 1e5).alias("value"))
    return to_wide(cells, keys, "name", TARGETS, "value")


def _sql_pick(names: list[str], number: str) -> str:
    return f"{names}[CAST({number} AS BIGINT) % {len(names)} + 1]"


_SQL_CELLS = f"""
    SELECT l_suppkey % 5 AS cfs_run, {LINE_MONTH}, l_linestatus AS model,
           {_sql_pick(FEATURE_LAKES, "l_linenumber")} AS lake, {_sql_pick(TARGET_COMPONENTS, "l_partkey")} AS component,
           CAST(sum({LINE_CENTS}) AS DOUBLE) / count(*) / 1e5 AS value
    FROM lineitem GROUP BY ALL
"""
_SQL_OBSERVED = f"""
    SELECT {ORDER_MONTH}, {_sql_pick(FEATURE_LAKES, "o_custkey")} AS lake,
           {_sql_pick(TARGET_COMPONENTS, "o_orderkey")} AS component,
           CAST(sum({ORDER_CENTS}) AS DOUBLE) / count(*) / 1e6 AS observed
    FROM orders GROUP BY ALL
"""


@query(
    f"""
    WITH monthly AS (SELECT year, month, model, lake, component, avg(value) AS p FROM ({_SQL_CELLS}) GROUP BY ALL),
    pairs AS (SELECT m.*, observed AS o FROM monthly m JOIN ({_SQL_OBSERVED}) USING (year, month, lake, component)),
    whole AS (SELECT * FROM pairs QUALIFY count(*) OVER (PARTITION BY year, month, model) = 16),
    grouped AS (
        SELECT *, unnest(CASE component
            WHEN 'cnbs' THEN ['All', 'CNBS']
            WHEN 'precipitation' THEN ['All', 'Components', 'Precipitation']
            WHEN 'evaporation' THEN ['All', 'Components', 'Evaporation']
            ELSE ['All', 'Components', 'Runoff'] END) AS "group"
        FROM whole
    )
    SELECT model, "group", count(*) AS n_pairs, round(sqrt(avg((p - o) * (p - o))) / stddev_pop(o), 6) AS rmse,
           round(1 - avg((p - o) * (p - o)) / var_pop(o), 6) AS r2, round(avg(p - o), 6) AS bias,
           round(var_pop(p), 6) AS variance, round(avg(abs(p - o)), 6) AS crps
    FROM grouped GROUP BY model, "group"
    """
)
def verification_flow(spark: SparkSession, folder: str) -> DataFrame:
    scores = verify(_predictions(spark, folder), _observed(spark, folder), digits=None)
    return scores.withColumns({name: F.round(name, 6) for name in ("rmse", "r2", "bias", "variance", "crps")})


_SQL_PUBLISHED = f"""
    WITH rows AS (
        SELECT *, value / 1000 * CASE lake WHEN 'superior' THEN 82097e6 WHEN 'michigan-huron' THEN 117313e6
                  WHEN 'erie' THEN 25655e6 ELSE 19009e6 END / (day(last_day(make_date(year, month, 1))) * 86400) AS cms
        FROM ({_SQL_CELLS}) WHERE year * 12 + month >= 2001 * 12 + 3
    ), means AS (
        SELECT year AS forecast_year, month AS forecast_month, lake, component, avg(value) AS mm, avg(cms) AS cms
        FROM rows GROUP BY ALL
    )
"""


@query(
    f"""
    {_SQL_PUBLISHED}
    SELECT CAST(2001 AS INTEGER) AS current_year, CAST(3 AS INTEGER) AS current_month, forecast_year, forecast_month,
           lake, component, round(mm, 9) AS "value [mm]", round(cms, 6) AS "value [cms]"
    FROM means
    """
)
def published_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of coming months → both units → grand mean, tagged with the first month."""
    coming = forecast_cutoff(_predictions(spark, folder), AS_OF)
    table = published(ensemble_rows(coming, TARGETS).where("`value [mm]` IS NOT NULL"), digits=None)
    return table.withColumns(
        {"value [mm]": F.round("`value [mm]`", 9), "value [cms]": F.round("`value [cms]`", 6)}
    )


@query(
    f"""
    {_SQL_PUBLISHED}
    SELECT CAST(2001 AS INTEGER) AS current_year, CAST(3 AS INTEGER) AS current_month, lake, component,
           {", ".join(f"round(max(cms) FILTER (forecast_month = {k + 2}), 6) AS month_{k}" for k in range(1, 10))}
    FROM means GROUP BY lake, component
    """
)
def published_leads(spark: SparkSession, folder: str) -> DataFrame:
    coming = forecast_cutoff(_predictions(spark, folder), AS_OF)
    leads = published_by_lead(published(ensemble_rows(coming, TARGETS), digits=None), horizon=9)
    return leads.withColumns({f"month_{k}": F.round(f"month_{k}", 6) for k in range(1, 10)})


def _monthly_targets(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as targets of every month that has features: each line counts for all components of its lake."""
    lines = line_months(spark, folder).withColumns(
        {"lake": _pick(FEATURE_LAKES, F.col("l_linenumber")), "i": F.explode(F.sequence(F.lit(0), F.lit(len(TARGET_COMPONENTS) - 1)))}
    )
    named = lines.withColumn("name", F.concat("lake", F.lit("_"), _pick(TARGET_COMPONENTS, F.col("i"))))
    value = F.col("l_quantity") * (F.col("i") + 1)
    return to_wide(named.withColumn("observed", value), ["year", "month"], "name", TARGETS, "observed").na.drop("any")


def _model_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as a run table that is complete at every size: each line counts for all components of its place."""
    lines = line_months(spark, folder).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(len(PREDICTOR_COMPONENTS) - 1))))
    measures = F.array(F.col("cents") / 1e5, F.col("l_quantity").cast("double"), F.col("l_discount") * 100)
    keys = {
        "cfs_run": F.col("year").cast("long") * 1000000 + F.col("month") * 10000 + 100 + F.col("l_suppkey") % 2 * 6,
        "lake": _pick(FEATURE_LAKES, F.col("l_linenumber")),
        "surface_type": _pick(SURFACES, F.col("l_partkey")),
        "component": _pick(PREDICTOR_COMPONENTS, F.col("i")),
        "measure": F.get(measures, F.col("i")),
    }
    return lines.withColumns(keys).groupBy("cfs_run", "year", "month", "lake", "surface_type", "component").agg(F.avg("measure").alias("value [mm]"))


_TRAINED = ("1995-01-01", "1998-12-01")
_JUDGED = ("1999-01-01", "2001-12-01")


@query()
def training_flow(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly features, all targets, three models of full size, hold-out scores per model and target."""
    features = feature_matrix(_model_runs(spark, folder)).groupBy("year", "month").agg(
        *[F.avg(name).alias(name) for name in FEATURES]
    )
    return train(features, _monthly_targets(spark, folder), FEATURES, TARGETS, _TRAINED, _JUDGED)[1]


@query()
def forecast_flow(spark: SparkSession, folder: str) -> DataFrame:
    """Run table → cut-off → features → three models of all targets → published forecast."""
    runs = _model_runs(spark, folder)
    table = persisted(training_table(feature_matrix(runs), _monthly_targets(spark, folder)))
    ensemble = models.fit_ensemble(table, FEATURES, TARGETS, fit_scaler(table, FEATURES), fit_scaler(table, TARGETS))
    return forecast(runs, ensemble, AS_OF).published


@query(f"SELECT unnest(['GP', 'RF', 'LR']) AS model, target, true AS scored FROM (SELECT unnest({[*TARGETS, 'mean']}) AS target)")
def training_flow_keys(spark: SparkSession, folder: str) -> DataFrame:
    """The models and targets of ``training_flow``, and that each has scores."""
    scores = training_flow(spark, folder)
    observed = F.regexp_replace("target", "_obs$", "")
    return scores.select("model", observed.alias("target"), ((F.col("mse") >= 0) & (F.col("r2") <= 1)).alias("scored"))


@query(
    f"""
    WITH cells AS (
        SELECT year, month, cfs_run FROM (
            SELECT {LINE_MONTH}, year(l_shipdate) * 1000000 + month(l_shipdate) * 10000 + 100 + l_suppkey % 2 * 6 AS cfs_run,
                   l_linenumber % {len(FEATURE_LAKES)} AS lake, l_partkey % {len(SURFACES)} AS surface
            FROM lineitem WHERE year(l_shipdate) * 12 + month(l_shipdate) >= 2001 * 12 + 3)
        GROUP BY year, month, cfs_run
        HAVING count(DISTINCT (lake, surface)) = {len(FEATURE_LAKES) * len(SURFACES)}),
    months AS (SELECT DISTINCT year, month FROM cells),
    names AS (SELECT unnest({FEATURE_LAKES}) AS lake), parts AS (SELECT unnest({TARGET_COMPONENTS}) AS component)
    SELECT (SELECT CAST(min(year * 100 + month) // 100 AS INTEGER) FROM months) AS current_year,
           (SELECT CAST(min(year * 100 + month) % 100 AS INTEGER) FROM months) AS current_month,
           year AS forecast_year, month AS forecast_month, lake, component, true AS published
    FROM months, names, parts
    """
)
def forecast_flow_keys(spark: SparkSession, folder: str) -> DataFrame:
    """The months, lakes and components of ``forecast_flow``, and that each has values."""
    rows = forecast_flow(spark, folder)
    found = F.col("`value [mm]`").isNotNull() & F.col("`value [cms]`").isNotNull()
    return rows.select("current_year", "current_month", "forecast_year", "forecast_month", "lake", "component", found.alias("published"))
