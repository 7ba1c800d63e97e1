"""The test tables in the roles of the forecasting domain.

Months come from ship and order dates, series from return flags and priorities, runs from 6-hour buckets of events, and
grid cells from quantity (latitude) and line number (longitude). Prices are taken in whole cents where sums must not
depend on the order of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basinspark.functions.calendar import run_id

LINE_MONTH = "CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month"
ORDER_MONTH = "CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month"
LINE_CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"
ORDER_CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"
EVENT_CENTS = "CAST(round(value * 100) AS BIGINT)"
EVENT_RUN = (
    "CAST(strftime(time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '2000-01-01 00:00:00'), '%Y%m%d%H') AS BIGINT)"
)


def linear_quantile(value: str, probability: float) -> str:
    """SQL for a quantile with linear interpolation, in the order of operations of a data frame library."""
    values, rank = f"list_sort(list(CAST({value} AS DOUBLE)))", f"({probability}::DOUBLE * (count({value}) - 1))"
    low = f"{values}[CAST(floor({rank}) AS BIGINT) + 1]"
    high = f"{values}[CAST(ceil({rank}) AS BIGINT) + 1]"
    return f"({low} + ({high} - {low}) * ({rank} - floor({rank})))"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("long")


def monthly(df: DataFrame, date: str) -> DataFrame:
    return df.withColumns({"year": F.year(date), "month": F.month(date)})


def line_months(spark: SparkSession, folder: str) -> DataFrame:
    return monthly(table(spark, folder, "lineitem"), "l_shipdate").withColumn("cents", cents("l_extendedprice"))


def order_months(spark: SparkSession, folder: str) -> DataFrame:
    return monthly(table(spark, folder, "orders"), "o_orderdate").withColumn("cents", cents("o_totalprice"))


def run_of(ts: str) -> Column:
    """Run identifier of the 6-hour bucket of a zone-free timestamp."""
    bucket = F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.floor(F.hour(ts) / 6).cast("int") * 6, F.lit(0), F.lit(0)
    )
    return run_id(bucket)


def event_runs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").withColumns({"run": run_of("ts"), "cents": cents("value")})
