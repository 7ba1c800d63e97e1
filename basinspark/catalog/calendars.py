"""Queries on months, runs, unit conversions and observation formats."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinspark.catalog import query
from basinspark.catalog.inputs import EVENT_RUN, LINE_CENTS, LINE_MONTH, ORDER_CENTS, event_runs, line_months, order_months
from basinspark.functions import calendar, hydro
from basinspark.operators.ensemble import ensemble_mean
from basinspark.operators.shape import to_wide
from basinspark.operators.skill import format_leads, format_observed
from basinspark.schemas import MONTH_NAMES

AREAS = {"A": 82097e6, "N": 25655e6}
_AREA_SQL = "CASE lake WHEN 'A' THEN 82097e6 WHEN 'N' THEN 25655e6 END"
_SECONDS_SQL = "(day(last_day(make_date(year, month, 1))) * 86400)"
_LAKE_MEANS = f"""
    SELECT l_returnflag AS lake, {LINE_MONTH}, CAST(sum({LINE_CENTS}) AS DOUBLE) / count(*) AS value
    FROM lineitem GROUP BY ALL
"""


def _lake_means(spark: SparkSession, folder: str) -> DataFrame:
    lines = line_months(spark, folder).withColumnRenamed("l_returnflag", "lake")
    return ensemble_mean(lines, ["lake", "year", "month"], {"cents": "value"})


@query(
    f"""
    SELECT *, CAST({_SECONDS_SQL} AS BIGINT) AS seconds,
           value / 1000 * coalesce({_AREA_SQL}, 0.0) / {_SECONDS_SQL} AS cms
    FROM ({_LAKE_MEANS})
    """
)
def area_lookup_cms(spark: SparkSession, folder: str) -> DataFrame:
    return _lake_means(spark, folder).withColumns(
        {
            "seconds": calendar.seconds_in_month("year", "month"),
            "cms": hydro.mm_to_cms("value", "lake", "year", "month", AREAS),
        }
    )


@query(
    f"""
    SELECT *, coalesce(value * {_SECONDS_SQL} / {_AREA_SQL} * 1000, value) AS mm FROM ({_LAKE_MEANS})
    """
)
def cms_to_mm(spark: SparkSession, folder: str) -> DataFrame:
    return _lake_means(spark, folder).withColumn("mm", hydro.cms_to_mm("value", "lake", "year", "month", AREAS))


@query(
    """
    SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice,
           l_extendedprice * 1e-6 / (2.501::DOUBLE - 0.002361::DOUBLE * ((l_quantity + 260.0) - 273.15::DOUBLE)) AS rate
    FROM lineitem
    """
)
def evaporation_rate(spark: SparkSession, folder: str) -> DataFrame:
    lines = line_months(spark, folder)
    return lines.select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_extendedprice",
        hydro.evaporation_rate(F.col("l_quantity") + 260.0, "l_extendedprice").alias("rate"),
    )


@query(
    f"""
    SELECT run, strftime(t + CASE hour(t) WHEN 18 THEN INTERVAL 6 HOURS WHEN 12 THEN INTERVAL 6 HOURS
                                  WHEN 6 THEN INTERVAL 6 HOURS ELSE to_hours(6 - hour(t)) END, '%m-%d-%Y %H') AS label
    FROM (SELECT DISTINCT {EVENT_RUN} AS run, strptime(CAST({EVENT_RUN} AS VARCHAR), '%Y%m%d%H') AS t FROM events)
    """
)
def next_run(spark: SparkSession, folder: str) -> DataFrame:
    runs = event_runs(spark, folder).select("run").distinct()
    return runs.select("run", calendar.next_run("run").alias("label"))


@query(
    f"""
    WITH spans AS (
        SELECT user_id, min(strptime(CAST({EVENT_RUN} AS VARCHAR), '%Y%m%d%H')) AS a,
               max(strptime(CAST({EVENT_RUN} AS VARCHAR), '%Y%m%d%H')) AS b
        FROM events GROUP BY user_id
    ), steps AS (SELECT user_id, unnest(generate_series(a, b, INTERVAL 6 HOURS)) AS t FROM spans)
    SELECT user_id, t AS run_ts, CAST(strftime(t, '%Y%m%d%H') AS BIGINT) AS run,
           strftime(t, 'cfs.%Y%m%d/%H/monthly_grib_01/') AS path
    FROM steps
    """
)
def run_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """All runs between the first and the last event of each user."""
    spans = (
        event_runs(spark, folder)
        .groupBy("user_id")
        .agg(F.min("run").alias("first"), F.max("run").alias("last"))
        .select("user_id", calendar.run_moment("first").alias("a"), calendar.run_moment("last").alias("b"))
    )
    return calendar.run_calendar(spans, "a", "b").select(
        "user_id",
        "run_ts",
        calendar.run_id("run_ts").alias("run"),
        calendar.run_path("run_ts", "cfs.", "/monthly_grib_01/").alias("path"),
    )


@query(
    f"""
    WITH latest AS (SELECT user_id, max(strptime(CAST({EVENT_RUN} AS VARCHAR), '%Y%m%d%H')) AS t FROM events GROUP BY 1),
    steps AS (
        SELECT user_id, unnest(generate_series(t + INTERVAL 6 HOURS, TIMESTAMP '2024-02-01 18:00:00', INTERVAL 6 HOURS)) AS t
        FROM latest
    )
    SELECT user_id, CAST(strftime(t, '%Y%m%d%H') AS BIGINT) AS run FROM steps
    """
)
def catch_up_runs(spark: SparkSession, folder: str) -> DataFrame:
    return calendar.missing_runs(event_runs(spark, folder), "run", dt.date(2024, 2, 2), by=["user_id"])


@query(
    f"""
    WITH w AS (
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS forecast_date, o_orderpriority,
               CAST(sum({ORDER_CENTS}) AS DOUBLE) / count(*) AS m
        FROM orders GROUP BY ALL
    )
    SELECT forecast_date, CAST(forecast_date + to_months(CAST(left(o_orderpriority, 1) AS INTEGER) - 1) AS DATE)
               AS valid_month, m AS nbs
    FROM w
    """
)
def lead_to_valid_month(spark: SparkSession, folder: str) -> DataFrame:
    """Priorities 1 to 5 stand for the leads one to five."""
    orders = order_months(spark, folder).withColumn(
        "lead", F.get(F.array(*[F.lit(w) for w in ("one", "two", "three", "four", "five")]), F.substring("o_orderpriority", 1, 1).cast("int") - 1)
    )
    leads = ["one", "two", "three", "four", "five"]
    return format_leads(to_wide(orders, ["year", "month"], "lead", leads, "cents"), leads=leads).where("nbs IS NOT NULL")


@query(
    f"""
    SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start,
           CAST(sum({LINE_CENTS}) AS DOUBLE) / count(*) AS observed
    FROM lineitem WHERE month(l_shipdate) <> 3 GROUP BY ALL
    """
)
def month_name_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Year × month table with padded names and a sentinel in place of each March, unpivoted."""
    lines = line_months(spark, folder).withColumn("name", F.get(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.col("month") - 1))
    wide = to_wide(lines, ["year"], "name", MONTH_NAMES, "cents")
    padded = wide.select(
        F.col("year").alias("Year"),
        *[(F.lit(-99990.0) if m == "Mar" else F.col(m)).alias(f" {m}") for m in MONTH_NAMES],
    )
    return format_observed(padded, months=[f" {m}" for m in MONTH_NAMES])


@query(
    f"""
    SELECT l_orderkey, l_partkey, {LINE_MONTH}, strftime(l_shipdate, '%Y_%m') AS label,
           CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start,
           CAST(day(last_day(l_shipdate)) AS INTEGER) AS days,
           {", ".join(f"CAST(month(l_shipdate) = {m} AS INTEGER) AS month_{m}" for m in range(1, 13))}
    FROM lineitem
    """
)
def month_columns(spark: SparkSession, folder: str) -> DataFrame:
    lines = line_months(spark, folder).select(
        "l_orderkey",
        "l_partkey",
        "year",
        "month",
        calendar.month_label("year", "month", "_").alias("label"),
        calendar.month_start("year", "month").alias("month_start"),
        calendar.days_in_month("year", "month").alias("days"),
    )
    return calendar.month_one_hot(lines, "month")
