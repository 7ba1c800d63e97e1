"""Queries on projections, filters, names and record checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinspark.catalog import query
from basinspark.catalog.inputs import (
    EVENT_RUN,
    LINE_CENTS,
    LINE_MONTH,
    ORDER_CENTS,
    ORDER_MONTH,
    cents,
    event_runs,
    line_months,
    order_months,
    table,
)
from basinspark.functions.numbers import rounded
from basinspark.operators import records, shape
from basinspark.operators.ensemble import ensemble_mean, forecast_cutoff, tag_first_period
from basinspark.operators.features import date_split


@query(
    """
    SELECT l_orderkey AS orderkey, l_linenumber AS linenumber, l_linestatus AS linestatus, l_quantity AS "value [mm]"
    FROM lineitem WHERE month(l_shipdate) = 7 AND year(l_shipdate) = 1998
    """
)
def series_slice(spark: SparkSession, folder: str) -> DataFrame:
    lines = line_months(spark, folder).where((F.col("month") == 7) & (F.col("year") == 1998))
    short = {name: name.removeprefix("l_") for name in shape.columns_like(lines, prefix="l_")}
    renamed = lines.withColumnsRenamed(short).withColumnRenamed("quantity", "value [mm]")
    return renamed.select("orderkey", "linenumber", "linestatus", "value [mm]")


@query(
    """
    SELECT page_id, starts_with(url, 'https') AS secure, ends_with(url, '.html') AS plain,
           contains(url, 'utm_') AS tracked, string_split(url, '/')[3] AS host, substring(url, 1, 5) AS head,
           lpad(CAST(page_id % 100 AS VARCHAR), 2, '0') AS two_digits,
           CASE WHEN ends_with(url, '.html') THEN left(url, length(url) - 5) ELSE url END AS stem
    FROM pages
    """
)
def string_tests(spark: SparkSession, folder: str) -> DataFrame:
    url = F.col("url")
    return table(spark, folder, "pages").select(
        "page_id",
        url.startswith("https").alias("secure"),
        url.endswith(".html").alias("plain"),
        url.contains("utm_").alias("tracked"),
        F.get(F.split(url, "/"), 2).alias("host"),
        F.substring(url, 1, 5).alias("head"),
        F.lpad((F.col("page_id") % 100).cast("string"), 2, "0").alias("two_digits"),
        F.regexp_replace(url, r"\.html$", "").alias("stem"),
    )


@query(
    f"""
    SELECT o_orderpriority, o_orderstatus, round_even(CAST(sum({ORDER_CENTS}) AS DOUBLE) / count(*), 3) AS mean_cents
    FROM orders GROUP BY ALL
    """
)
def rounded_mean(spark: SparkSession, folder: str) -> DataFrame:
    return ensemble_mean(
        order_months(spark, folder), ["o_orderpriority", "o_orderstatus"], {"cents": "mean_cents"}, digits=3
    )


@query(
    """
    SELECT l_returnflag, l_linestatus, round(var_pop(l_quantity), 6) AS variance, avg(l_quantity) AS mean_quantity,
           avg(l_quantity * l_quantity) AS mean_square, round(sqrt(avg(l_quantity * l_quantity)), 9) AS root,
           round(sum(cos(radians(l_quantity))), 6) AS cosines,
           min(least(l_quantity, CAST(l_linenumber * 7 AS DOUBLE))) AS lower_side,
           max(greatest(l_quantity, CAST(l_linenumber * 7 AS DOUBLE))) AS upper_side
    FROM lineitem GROUP BY ALL
    """
)
def moments(spark: SparkSession, folder: str) -> DataFrame:
    q, other = F.col("l_quantity"), (F.col("l_linenumber") * 7).cast("double")
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.round(F.var_pop(q), 6).alias("variance"),
            F.avg(q).alias("mean_quantity"),
            F.avg(q * q).alias("mean_square"),
            F.round(F.sqrt(F.avg(q * q)), 9).alias("root"),
            F.round(F.sum(F.cos(F.radians(q))), 6).alias("cosines"),
            F.min(F.least(q, other)).alias("lower_side"),
            F.max(F.greatest(q, other)).alias("upper_side"),
        )
    )


_CUTOFF_SQL = f"""
    SELECT {ORDER_MONTH}, count(*) AS n_orders FROM orders
    WHERE year(o_orderdate) * 12 + month(o_orderdate) >= {{first}} GROUP BY ALL
"""


def _cutoff_counts(spark: SparkSession, folder: str, as_of: dt.date) -> DataFrame:
    kept = forecast_cutoff(order_months(spark, folder), as_of)
    return kept.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_orders"))


@query(_CUTOFF_SQL.format(first=1998 * 12 + 5))
def forecast_cutoff_early(spark: SparkSession, folder: str) -> DataFrame:
    return _cutoff_counts(spark, folder, dt.date(1998, 5, 25))


@query(_CUTOFF_SQL.format(first=1998 * 12 + 6))
def forecast_cutoff_late(spark: SparkSession, folder: str) -> DataFrame:
    return _cutoff_counts(spark, folder, dt.date(1998, 5, 26))


@query(_CUTOFF_SQL.format(first=1999 * 12 + 1))
def forecast_cutoff_year_end(spark: SparkSession, folder: str) -> DataFrame:
    return _cutoff_counts(spark, folder, dt.date(1998, 12, 26))


@query(
    f"""
    SELECT CASE WHEN o_orderdate <= '1998-12-01' THEN 'train' ELSE 'test' END AS part, o_orderpriority,
           count(*) AS n_rows, CAST(sum({ORDER_CENTS}) AS BIGINT) AS cents
    FROM orders
    WHERE o_orderdate BETWEEN '1995-03-01' AND '1998-12-01' OR o_orderdate BETWEEN '1999-01-01' AND '2001-01-01'
    GROUP BY ALL
    """
)
def date_ranges(spark: SparkSession, folder: str) -> DataFrame:
    parts = date_split(
        order_months(spark, folder), "o_orderdate", ("1995-03-01", "1998-12-01"), ("1999-01-01", "2001-01-01")
    )
    tagged = [part.withColumn("part", F.lit(name)) for name, part in zip(("train", "test"), parts, strict=True)]
    return (
        tagged[0]
        .unionByName(tagged[1])
        .groupBy("part", "o_orderpriority")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("cents").alias("cents"))
    )


@query(
    """
    SELECT d.lang || '_' || d.source || '_' || l.quality AS variable, count(*) AS n_documents
    FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY ALL
    """
)
def variable_name(spark: SparkSession, folder: str) -> DataFrame:
    labelled = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    named = shape.add_composite(labelled, ["lang", "source", "quality"], "variable")
    return named.groupBy("variable").agg(F.count(F.lit(1)).alias("n_documents"))


@query(
    """
    SELECT o_orderkey, string_split(o_orderpriority, '-')[1] AS rank, string_split(o_orderpriority, '-')[2] AS name,
           string_split(o_orderpriority, '-')[3] AS rest
    FROM orders
    """
)
def split_name(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return shape.split_composite(orders, "o_orderpriority", ["rank", "name", "rest"], "-").select(
        "o_orderkey", "rank", "name", "rest"
    )


@query(
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' ELSE o_orderstatus END AS status
    FROM orders
    """
)
def recode_default(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    return shape.recode(orders, "status", {"O": "open", "F": "filled"}, unknown="keep")


@query(
    """
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_brand AS brand,
           CASE l_returnflag WHEN 'A' THEN 'erie' WHEN 'N' THEN 'ontario' WHEN 'R' THEN 'superior' END AS lake
    FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
    """
)
def recode_strict(spark: SparkSession, folder: str) -> DataFrame:
    """A small literal lookup and a lookup table, both with an error for unknown values."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_partkey").cast("string").alias("brand"),
        F.col("l_returnflag").alias("lake"),
    )
    parts = table(spark, folder, "part").select(F.col("p_partkey").cast("string").alias("code"), "p_brand")
    named = shape.recode(lines, "lake", {"A": "erie", "N": "ontario", "R": "superior"})
    return shape.recode(named, "brand", parts)


@query(
    """
    SELECT unnest(['doc_id', 'lang', 'quality', 'toxic']) AS column_name,
           unnest([count(*) - count(d.doc_id), count(*) - count(lang), count(*) - count(quality),
                   count(*) - count(toxic)]) AS n_missing
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """
)
def null_report(spark: SparkSession, folder: str) -> DataFrame:
    labelled = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    return records.null_report(labelled, ["doc_id", "lang", "quality", "toxic"])


@query(
    """
    SELECT d.doc_id, d.n_chars, CASE WHEN quality IS NULL OR toxic IS NULL THEN 'incomplete' ELSE 'complete' END AS state
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """
)
def complete_rows(spark: SparkSession, folder: str) -> DataFrame:
    labelled = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    labelled = labelled.select("doc_id", "n_chars", "quality", "toxic")
    parts = {"complete": records.drop_incomplete(labelled), "incomplete": records.incomplete_rows(labelled)}
    tagged = [df.select("doc_id", "n_chars", F.lit(name).alias("state")) for name, df in parts.items()]
    return tagged[0].unionByName(tagged[1])


@query(
    f"""
    SELECT l_returnflag, count(nullif(l_quantity, 50.0)) AS n_valid, avg(nullif(l_quantity, 50.0)) AS mean_quantity,
           CAST(sum({LINE_CENTS}) FILTER (l_quantity <> 50.0) AS BIGINT) AS cents
    FROM lineitem GROUP BY ALL
    """
)
def sentinel_to_null(spark: SparkSession, folder: str) -> DataFrame:
    lines = line_months(spark, folder).select("l_returnflag", "l_quantity", "cents")
    cleaned = records.null_sentinel(lines, ["l_quantity"], 50.0, drop=True)
    return cleaned.groupBy("l_returnflag").agg(
        F.count("l_quantity").alias("n_valid"),
        F.avg("l_quantity").alias("mean_quantity"),
        F.sum("cents").alias("cents"),
    )


@query(
    f"""
    SELECT event_id, {EVENT_RUN} AS cfs_run, CAST(user_id % 14 AS INTEGER) AS month,
           CASE WHEN user_id % 14 NOT BETWEEN 1 AND 12 THEN 'month outside 1-12'
                WHEN event_type = 'error' THEN 'key missing'
                WHEN value < 0.5 THEN 'value missing' ELSE 'accepted' END AS verdict
    FROM events
    """
)
def validated_records(spark: SparkSession, folder: str) -> DataFrame:
    """Events as records of the run table, some of them broken; accepted and rejected rows with the reason."""
    rows = event_runs(spark, folder).select(
        "event_id",
        F.col("run").alias("cfs_run"),
        F.year("ts").alias("year"),
        (F.col("user_id") % 14).cast("int").alias("month"),
        F.nullif(F.col("event_type"), F.lit("error")).alias("lake"),
        F.lit("lake").alias("surface_type"),
        F.lit("precipitation").alias("component"),
        F.when(F.col("value") >= 0.5, F.col("value")).alias("value [mm]"),
    )
    accepted, rejected = records.split_valid(rows, records.run_record_rules(), "verdict")
    checked = records.validated(accepted, records.run_record_rules())
    return (
        checked.withColumn("verdict", F.lit("accepted"))
        .unionByName(rejected)
        .select("event_id", "cfs_run", "month", "verdict")
    )


@query(
    f"""
    WITH m AS (
        SELECT {LINE_MONTH}, l_returnflag AS lake, CAST(sum({LINE_CENTS}) AS DOUBLE) / count(*) AS mean_cents
        FROM lineitem GROUP BY ALL
    ), f AS (SELECT year AS current_year, month AS current_month FROM m ORDER BY year, month LIMIT 1)
    SELECT * FROM m, f
    """
)
def current_month_tag(spark: SparkSession, folder: str) -> DataFrame:
    lines = line_months(spark, folder).withColumnRenamed("l_returnflag", "lake")
    return tag_first_period(ensemble_mean(lines, ["year", "month", "lake"], {"cents": "mean_cents"}), "year", "month")


@query(
    f"""
    WITH w AS (
        SELECT {LINE_MONTH},
               CAST(sum({LINE_CENTS}) FILTER (l_returnflag = 'A') AS DOUBLE) / count(*) FILTER (l_returnflag = 'A') AS a,
               CAST(sum({LINE_CENTS}) FILTER (l_returnflag = 'N') AS DOUBLE) / count(*) FILTER (l_returnflag = 'N') AS n,
               CAST(sum({LINE_CENTS}) FILTER (l_returnflag = 'R') AS DOUBLE) / count(*) FILTER (l_returnflag = 'R') AS r
        FROM lineitem GROUP BY ALL
    )
    SELECT year, month, (a + n) / 117313.0::DOUBLE AS michigan_huron, (a + n) / 2.0::DOUBLE AS mean_temperature,
           r / 82097.0::DOUBLE AS superior
    FROM w
    """
)
def basin_merge(spark: SparkSession, folder: str) -> DataFrame:
    wide = shape.to_wide(line_months(spark, folder), ["year", "month"], "l_returnflag", ["A", "N", "R"], "cents")
    spec = {
        "michigan_huron": ("total", ["A", "N"], 57753 + 59560),
        "mean_temperature": ("mean", ["A", "N"]),
        "superior": ("total", ["R"], 82097),
    }
    return shape.merge_basins(wide, ["year", "month"], spec)


@query(
    f"""
    WITH parts AS (
        SELECT {LINE_MONTH}, CAST(sum({LINE_CENTS}) FILTER (l_returnflag = 'A') AS BIGINT) AS p,
               CAST(sum({LINE_CENTS}) FILTER (l_returnflag = 'N') AS BIGINT) AS e,
               CAST(sum({LINE_CENTS}) FILTER (l_returnflag = 'R') AS BIGINT) AS r
        FROM lineitem GROUP BY ALL
    ), total AS (SELECT {ORDER_MONTH}, CAST(sum({ORDER_CENTS}) AS BIGINT) AS t FROM orders GROUP BY ALL)
    SELECT year, month, t AS published, p - e + r AS computed, t - (p - e + r) AS gap
    FROM parts FULL JOIN total USING (year, month)
    """
)
def closure_gap(spark: SparkSession, folder: str) -> DataFrame:
    parts = shape.recode(
        line_months(spark, folder).select("year", "month", F.col("l_returnflag").alias("component"), "cents"),
        "component",
        {"A": "precipitation", "N": "evaporation", "R": "runoff"},
    )
    totals = order_months(spark, folder).select("year", "month", F.lit("cnbs").alias("component"), "cents")
    return shape.closure_gap(parts.unionByName(totals), ["year", "month"], "component", "cents")


@query(
    """
    SELECT o_orderkey, o_totalprice AS value, 0 AS month_1, 0 AS month_2
    FROM orders
    """
)
def ensured_columns(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_totalprice").alias("value"))
    return shape.ensure_columns(orders, ["value", "month_1", "month_2"])


@query(
    f"""
    SELECT o_orderkey, round_even({ORDER_CENTS} / 1000.0::DOUBLE, 1) AS tens
    FROM orders
    """
)
def half_even(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey", rounded(cents("o_totalprice") / F.lit(1000.0), 1).alias("tens")
    )
