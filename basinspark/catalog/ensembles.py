"""Queries on ensemble statistics, reshaping and series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinspark.catalog import query
from basinspark.catalog.inputs import (
    EVENT_CENTS,
    EVENT_RUN,
    LINE_CENTS,
    LINE_MONTH,
    ORDER_CENTS,
    event_runs,
    line_months,
    linear_quantile,
    order_months,
    table,
)
from basinspark.functions.calendar import month_one_hot, month_start
from basinspark.functions.hydro import mm_to_cms
from basinspark.operators import ensemble, shape
from basinspark.operators.windows import lag_lead, lag_lead_by_month
from basinspark.session import persisted

AREAS = {"A": 82097e6, "N": 25655e6, "R": 19009e6}
_NAMES = [f"{lake}_{component}" for lake in "ANR" for component in "FO"]


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return line_months(spark, folder).withColumnsRenamed(
        {"l_returnflag": "lake", "l_linestatus": "component"}
    )


def _round_mean(value: str, digits: int = 3) -> str:
    return f"round_even(CAST(sum({value}) AS DOUBLE) / count(*), {digits})"


@query(
    f"""
    SELECT {LINE_MONTH}, CAST(l_linenumber AS VARCHAR) AS model, l_returnflag AS lake, l_linestatus AS component,
           {_round_mean(LINE_CENTS)} AS value_mm, {_round_mean("CAST(l_quantity AS BIGINT)")} AS value_cms
    FROM lineitem GROUP BY ALL
    """
)
def model_mean(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder).withColumn("model", F.col("l_linenumber").cast("string"))
    keys = ["year", "month", "model", "lake", "component"]
    return ensemble.ensemble_mean(lines, keys, {"cents": "value_mm", "l_quantity": "value_cms"}, digits=3)


@query(
    f"""
    SELECT {LINE_MONTH}, l_returnflag AS lake, l_linestatus AS component,
           {_round_mean(LINE_CENTS)} AS value_mm, {_round_mean("CAST(l_quantity AS BIGINT)")} AS value_cms
    FROM lineitem GROUP BY ALL
    """
)
def grand_mean(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["year", "month", "lake", "component"]
    return ensemble.ensemble_mean(
        _lines(spark, folder), keys, {"cents": "value_mm", "l_quantity": "value_cms"}, digits=3
    )


@query(
    f"""
    SELECT {LINE_MONTH}, l_returnflag AS lake, l_linestatus AS component,
           median({LINE_CENTS}) AS cents, median(l_quantity) AS l_quantity
    FROM lineitem GROUP BY ALL
    """
)
def model_median(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["year", "month", "lake", "component"]
    return ensemble.ensemble_median(_lines(spark, folder), keys, ["cents", "l_quantity"])


@query(
    f"""
    SELECT {LINE_MONTH}, {linear_quantile(LINE_CENTS, 0.025)} AS cents_lower,
           {linear_quantile(LINE_CENTS, 0.975)} AS cents_upper
    FROM lineitem GROUP BY ALL
    """
)
def quantile_band(spark: SparkSession, folder: str) -> DataFrame:
    return ensemble.quantile_band(_lines(spark, folder), ["year", "month"], ["cents"])


@query(
    f"""
    SELECT event_type, {linear_quantile("value", 0.025)} AS value_lower,
           {linear_quantile("value", 0.975)} AS value_upper, {linear_quantile("value", 0.5)} AS value_middle
    FROM events GROUP BY event_type
    """
)
def large_group_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Few large groups; each is spread over many tasks."""
    bands = ensemble.exact_quantiles(
        table(spark, folder, "events"),
        ["event_type"],
        ["value"],
        {"lower": 0.025, "upper": 0.975, "middle": 0.5},
        small_group=1000,
    )
    return bands


@query(
    f"""
    SELECT event_type, {linear_quantile("v", 0.025)} AS v_lower, {linear_quantile("v", 0.5)} AS v_middle
    FROM (SELECT event_type, CASE WHEN event_type <> 'click' THEN value END AS v FROM events) GROUP BY event_type
    """
)
def quantiles_empty_group(spark: SparkSession, folder: str) -> DataFrame:
    """Large groups, one of which has no value and keeps its row."""
    events = table(spark, folder, "events").withColumn("v", F.when(F.col("event_type") != "click", F.col("value")))
    return ensemble.exact_quantiles(events, ["event_type"], ["v"], {"lower": 0.025, "middle": 0.5}, small_group=1000)


@query(
    f"""
    SELECT {LINE_MONTH}, l_returnflag AS model, CAST(sum(cents) FILTER (NOT isnan(cents)) AS DOUBLE) / count(*) FILTER (NOT isnan(cents)) AS cents
    FROM (SELECT *, CASE WHEN l_linenumber = 3 THEN 'NaN'::DOUBLE ELSE CAST({LINE_CENTS} AS DOUBLE) END AS cents FROM lineitem)
    GROUP BY ALL
    """
)
def mean_skips_nan(spark: SparkSession, folder: str) -> DataFrame:
    nan = F.when(F.col("l_linenumber") == 3, F.lit(float("nan"))).otherwise(F.col("cents").cast("double"))
    lines = line_months(spark, folder).withColumns({"cents": nan, "model": F.col("l_returnflag")})
    return ensemble.ensemble_mean(lines, ["year", "month", "model"], ["cents"])


@query(
    f"""
    SELECT event_type, CAST(sum(event_id) AS DOUBLE) / count(*) AS event_id,
           CAST(sum(user_id) AS DOUBLE) / count(*) AS user_id, CAST(sum({EVENT_RUN}) AS DOUBLE) / count(*) AS run,
           CAST(sum({EVENT_CENTS}) AS DOUBLE) / count(*) AS cents, round(avg(value), 6) AS value
    FROM events GROUP BY event_type
    """
)
def numeric_means(spark: SparkSession, folder: str) -> DataFrame:
    means = ensemble.numeric_means(event_runs(spark, folder), ["event_type"])
    return means.withColumn("value", F.round("value", 6))  # the sum of a DOUBLE depends on the order of its rows


@query(
    """
    SELECT CASE WHEN event_type = 'error' THEN 'cnbs' ELSE 'components' END AS series_group,
           min(value) - 10 AS range_low, max(value) + 10 AS range_high
    FROM events GROUP BY 1
    """
)
def padded_range(spark: SparkSession, folder: str) -> DataFrame:
    by = F.when(F.col("event_type") == "error", "cnbs").otherwise("components")
    return ensemble.padded_range(table(spark, folder, "events"), by, "value")


_PIVOT_SQL = ", ".join(
    f"CAST(sum({LINE_CENTS}) FILTER (l_returnflag = '{n[0]}' AND l_linestatus = '{n[2]}') AS DOUBLE) / "
    f"nullif(count(*) FILTER (l_returnflag = '{n[0]}' AND l_linestatus = '{n[2]}'), 0) AS \"{n}\""
    for n in _NAMES
)


def _wide(spark: SparkSession, folder: str) -> DataFrame:
    named = shape.add_composite(_lines(spark, folder), ["lake", "component"], "variable")
    return shape.to_wide(named, ["year", "month"], "variable", _NAMES, "cents")


@query(
    f"""
    SELECT *, {", ".join(f"CAST(month = {m} AS INTEGER) AS month_{m}" for m in range(1, 13))}
    FROM (SELECT {LINE_MONTH}, {_PIVOT_SQL} FROM lineitem GROUP BY ALL)
    """
)
def pivot_features(spark: SparkSession, folder: str) -> DataFrame:
    return month_one_hot(_wide(spark, folder), "month")


@query(
    f"""
    SELECT {LINE_MONTH}, l_returnflag AS lake, l_linestatus AS component,
           CAST(sum({LINE_CENTS}) AS DOUBLE) / count(*) AS value
    FROM lineitem GROUP BY ALL
    """
)
def unpivot_predictions(spark: SparkSession, folder: str) -> DataFrame:
    long = shape.to_long(_wide(spark, folder), ["year", "month"], _NAMES, "name", "value")
    split = shape.split_composite(long, "name", ["lake", "component"]).drop("name")
    return split.where("value IS NOT NULL")


@query(
    f"""
    SELECT {LINE_MONTH}, CASE l_returnflag WHEN 'A' THEN 'erie' ELSE l_returnflag END AS lake,
           CASE l_linestatus WHEN 'F' THEN 'precipitation' ELSE l_linestatus END AS component,
           CAST(sum({LINE_CENTS}) AS DOUBLE) / count(*) AS value
    FROM lineitem GROUP BY ALL
    """
)
def wide_file_records(spark: SparkSession, folder: str) -> DataFrame:
    codes = {"lake": {"A": "erie"}, "component": {"F": "precipitation"}}
    rows = shape.wide_to_records(_wide(spark, folder), ["year", "month"], ["lake", "component"], "value", codes)
    return rows.where("value IS NOT NULL")


@query(
    f"""
    WITH m AS (
        SELECT *, dense_rank() OVER (ORDER BY year, month) AS k FROM (
            SELECT {LINE_MONTH}, l_returnflag AS lake, CAST(sum({LINE_CENTS}) AS DOUBLE) / count(*) AS v
            FROM lineitem GROUP BY ALL)
    )
    SELECT lake, {", ".join(f"max(v) FILTER (k = {k}) AS month_{k}" for k in range(1, 97))} FROM m GROUP BY lake
    """
)
def wide_by_lead(spark: SparkSession, folder: str) -> DataFrame:
    """Lead table of all months. The horizon of eight years is fixed, so that the schema does not depend on the data."""
    means = ensemble.ensemble_mean(_lines(spark, folder), ["year", "month", "lake"], {"cents": "v"})
    return ensemble.lead_table(means, ["lake"], "year", "month", "v", horizon=96)


@query(
    f"""
    WITH m AS (
        SELECT o_orderpriority AS series, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
               CAST(sum({ORDER_CENTS}) AS BIGINT) AS total FROM orders GROUP BY ALL
    ), w AS (
        SELECT *, lag(total, 1) OVER s AS "total_mo-1", lag(total, 2) OVER s AS "total_mo-2",
               lead(total, 1) OVER s AS total_mo1
        FROM m WINDOW s AS (PARTITION BY series ORDER BY month_start)
    )
    SELECT * FROM w WHERE "total_mo-2" IS NOT NULL AND total_mo1 IS NOT NULL
    """
)
def lag_lead_features(spark: SparkSession, folder: str) -> DataFrame:
    return lag_lead(_order_series(spark, folder), ["series"], ["month_start"], ["total"], lag=2, lead=1)


@query(
    f"""
    WITH m AS (
        SELECT o_orderpriority AS series, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
               CAST(sum({ORDER_CENTS}) AS BIGINT) AS total
        FROM orders WHERE o_orderpriority <> '3-MEDIUM' OR month(o_orderdate) <> 5 GROUP BY ALL
    )
    SELECT m.*, a.total AS "total_mo-1", b.total AS total_mo1
    FROM m JOIN m a ON a.series = m.series AND a.month_start + INTERVAL 1 MONTH = m.month_start
    JOIN m b ON b.series = m.series AND b.month_start = m.month_start + INTERVAL 1 MONTH
    """
)
def lag_lead_calendar(spark: SparkSession, folder: str) -> DataFrame:
    gap = _order_series(spark, folder).where("series <> '3-MEDIUM' OR month(month_start) <> 5")
    return lag_lead_by_month(gap, ["series"], "month_start", ["total"], lag=1, lead=1)


def _order_series(spark: SparkSession, folder: str) -> DataFrame:
    orders = order_months(spark, folder).withColumn("month_start", month_start("year", "month"))
    return orders.groupBy(F.col("o_orderpriority").alias("series"), "month_start").agg(F.sum("cents").alias("total"))


@query(
    """
    SELECT l_orderkey, l_partkey, l_shipdate, lag_1 AS "l_quantity_mo-1" FROM (
        SELECT *, lag(l_quantity) OVER (PARTITION BY l_linestatus
            ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS lag_1
        FROM lineitem
    ) WHERE lag_1 IS NOT NULL
    """
)
def lag_large_series(spark: SparkSession, folder: str) -> DataFrame:
    """Two series with half of all rows each, shifted in chunks."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    lines = table(spark, folder, "lineitem").select("l_linestatus", *order, "l_shipdate")
    shifted = lag_lead(lines, ["l_linestatus"], order, ["l_quantity"], lag=1, small_group=5000)
    return shifted.select("l_orderkey", "l_partkey", "l_shipdate", "l_quantity_mo-1")


@query(
    """
    SELECT event_type, ts, value, lead FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts) AS INTEGER) AS lead FROM events
    ) WHERE lead <= 8
    """
)
def first_leads(spark: SparkSession, folder: str) -> DataFrame:
    leads = ensemble.first_leads(table(spark, folder, "events"), ["event_type", "user_id"], ["ts"])
    return leads.select("event_type", "ts", "value", "lead")


@query(f"SELECT {EVENT_RUN} AS run FROM events ORDER BY run DESC LIMIT 1")
def newest_run(spark: SparkSession, folder: str) -> DataFrame:
    return event_runs(spark, folder).select("run").orderBy(F.desc("run")).limit(1)


@query(
    """
    SELECT event_id, value, CASE event_type WHEN 'view' THEN 'RF' WHEN 'click' THEN 'LR' ELSE 'GP' END AS model
    FROM events
    """
)
def union_models(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    parts = {
        "RF": events.where("event_type = 'view'"),
        "LR": events.where("event_type = 'click'"),
        "GP": events.where("event_type NOT IN ('view', 'click')"),
    }
    stacked = ensemble.union_models({name: df.select("event_id", "value") for name, df in parts.items()})
    return stacked.orderBy("model", "event_id")


@query(
    f"""
    WITH long AS (
        SELECT {LINE_MONTH}, l_linenumber AS cfs_run, l_returnflag AS lake, l_linestatus AS component,
               CAST(sum({LINE_CENTS}) AS DOUBLE) / count(*) AS mm
        FROM lineitem GROUP BY ALL
    ), both_units AS (
        SELECT *, mm / 1000 * CASE lake WHEN 'A' THEN 82097e6 WHEN 'N' THEN 25655e6 ELSE 19009e6 END
                  / (day(last_day(make_date(year, month, 1))) * 86400) AS cms
        FROM long
    )
    SELECT year, month, lake, component, round(avg(mm), 5) AS mean_mm, round(avg(cms), 3) AS mean_cms,
           {linear_quantile("mm", 0.025)} AS lower_mm, {linear_quantile("mm", 0.975)} AS upper_mm
    FROM both_units GROUP BY ALL
    """
)
def ensemble_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Composite name → pivot → unpivot → area lookup and unit conversion → grand mean with quantile band."""
    named = shape.add_composite(_lines(spark, folder), ["lake", "component"], "variable")
    index = ["l_linenumber", "year", "month"]
    wide = shape.to_wide(named, index, "variable", _NAMES, "cents")
    long = shape.split_composite(shape.to_long(wide, index, _NAMES, "name", "mm"), "name", ["lake", "component"])
    rows = persisted(
        long.where("mm IS NOT NULL").withColumn("cms", mm_to_cms("mm", "lake", "year", "month", AREAS))
    )
    keys = ["year", "month", "lake", "component"]
    means = ensemble.ensemble_mean(rows, keys, {"mm": "mean_mm", "cms": "mean_cms"})
    band = ensemble.quantile_band(rows, keys, ["mm"]).withColumnsRenamed(
        {"mm_lower": "lower_mm", "mm_upper": "upper_mm"}
    )
    return means.join(band, keys).withColumns(
        {"mean_mm": F.round("mean_mm", 5), "mean_cms": F.round("mean_cms", 3)}
    )
