"""Queries on joins, alignment and comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinspark.catalog import query
from basinspark.catalog.inputs import LINE_CENTS, LINE_MONTH, ORDER_CENTS, ORDER_MONTH, line_months, order_months, table
from basinspark.operators import joins
from basinspark.operators.ensemble import ensemble_mean

_LINE_MEANS = f"SELECT {LINE_MONTH}, CAST(sum({LINE_CENTS}) AS DOUBLE) / count(*) AS line_mean FROM lineitem GROUP BY ALL"
_ORDER_MEANS = f"SELECT {ORDER_MONTH}, CAST(sum({ORDER_CENTS}) AS DOUBLE) / count(*) AS order_mean FROM orders GROUP BY ALL"


def _line_means(spark: SparkSession, folder: str) -> DataFrame:
    return ensemble_mean(line_months(spark, folder), ["year", "month"], {"cents": "line_mean"})


def _order_means(spark: SparkSession, folder: str) -> DataFrame:
    return ensemble_mean(order_months(spark, folder), ["year", "month"], {"cents": "order_mean"})


@query(f"SELECT year, month, order_mean, line_mean FROM ({_ORDER_MEANS}) JOIN ({_LINE_MEANS}) USING (year, month)")
def keyed_alignment(spark: SparkSession, folder: str) -> DataFrame:
    frames = {
        "order_mean": (_order_means(spark, folder), "order_mean"),
        "line_mean": (_line_means(spark, folder), "line_mean"),
    }
    return joins.aligned_columns(frames, ["year", "month"])


@query(
    f"""
    SELECT l.l_orderkey, l.l_partkey, year, month, m.order_mean
    FROM (SELECT l_orderkey, l_partkey, {LINE_MONTH} FROM lineitem) l LEFT JOIN ({_ORDER_MEANS}) m USING (year, month)
    """
)
def obs_left_join(spark: SparkSession, folder: str) -> DataFrame:
    """Every line with the monthly observation, NULL after the last order month."""
    lines = line_months(spark, folder).select("l_orderkey", "l_partkey", "year", "month")
    return joins.attach_observed(lines, [_order_means(spark, folder)], ["year", "month"])


@query(
    f"""
    SELECT year, month, line_mean, order_mean, n_urgent FROM ({_LINE_MEANS}) JOIN ({_ORDER_MEANS}) USING (year, month)
    JOIN (SELECT {ORDER_MONTH}, count(*) AS n_urgent FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY ALL)
    USING (year, month)
    """
)
def obs_complete_join(spark: SparkSession, folder: str) -> DataFrame:
    urgent = (
        order_months(spark, folder)
        .where("o_orderpriority = '1-URGENT'")
        .groupBy("year", "month")
        .agg(F.count(F.lit(1)).alias("n_urgent"))
    )
    observations = [_order_means(spark, folder), urgent]
    return joins.attach_observed(_line_means(spark, folder), observations, ["year", "month"], complete=True)


@query(
    f"""
    WITH m AS (
        SELECT l_returnflag AS lake, {LINE_MONTH}, CAST(sum({LINE_CENTS}) AS DOUBLE) / count(*) AS v
        FROM lineitem WHERE (l_returnflag <> 'A' OR l_shipdate >= '1996-01-01')
                        AND (l_returnflag <> 'N' OR l_shipdate < '2001-01-01') GROUP BY ALL
    ), a AS (SELECT year, month, v AS a_obs FROM m WHERE lake = 'A'),
    n AS (SELECT year, month, v AS n_obs FROM m WHERE lake = 'N'),
    r AS (SELECT year, month, v AS r_obs FROM m WHERE lake = 'R')
    SELECT year, month, a_obs, n_obs, r_obs FROM a FULL JOIN n USING (year, month) FULL JOIN r USING (year, month)
    """
)
def obs_outer_join(spark: SparkSession, folder: str) -> DataFrame:
    lines = line_months(spark, folder)
    spans = {
        "a": lines.where("l_returnflag = 'A' AND year >= 1996"),
        "n": lines.where("l_returnflag = 'N' AND year < 2001"),
        "r": lines.where("l_returnflag = 'R'"),
    }
    series = {name: ensemble_mean(df, ["year", "month"], {"cents": "v"}) for name, df in spans.items()}
    return joins.outer_series(series, ["year", "month"], "v", suffix="_obs")


@query(f"SELECT year, month, order_mean, line_mean FROM ({_ORDER_MEANS}) JOIN ({_LINE_MEANS}) USING (year, month)")
def strict_align(spark: SparkSession, folder: str) -> DataFrame:
    """Every order month has line items, so the strict alignment holds."""
    return joins.strict_align(_order_means(spark, folder), _line_means(spark, folder), ["year", "month"])


@query(f"SELECT year, month FROM ({_LINE_MEANS}) ANTI JOIN ({_ORDER_MEANS}) USING (year, month)")
def unmatched_months(spark: SparkSession, folder: str) -> DataFrame:
    return joins.unmatched(_line_means(spark, folder), _order_means(spark, folder), ["year", "month"])


@query(
    """
    WITH a AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS i, o_orderstatus AS s, o_totalprice AS p FROM orders),
    b AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS i, o_orderstatus AS s,
                 CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice + 1 ELSE o_totalprice END AS p FROM orders),
    c AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS i, o_orderstatus AS s, o_totalprice AS p
          FROM orders WHERE o_custkey <> 20)
    SELECT a.i AS row_number, 'a / b' AS pair FROM a JOIN b USING (i) JOIN c USING (i) WHERE (a.s, a.p) <> (b.s, b.p)
    UNION ALL
    SELECT a.i, 'a / c' FROM a JOIN b USING (i) JOIN c USING (i) WHERE (a.s, a.p) <> (c.s, c.p)
    UNION ALL
    SELECT a.i, 'b / c' FROM a JOIN b USING (i) JOIN c USING (i) WHERE (b.s, b.p) <> (c.s, c.p)
    """
)
def table_compare(spark: SparkSession, folder: str) -> DataFrame:
    """Three versions of the orders row by row; the third lacks some rows, so later rows are shifted."""
    orders = table(spark, folder, "orders")
    changed = orders.withColumn(
        "o_totalprice",
        F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
    )
    frames = {"a": orders, "b": changed, "c": orders.where("o_custkey <> 20")}
    return joins.compare_rows(frames, ["o_orderkey"], ["o_orderstatus", "o_totalprice"])


@query(
    """
    WITH b AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'X' ELSE o_orderstatus END AS s
               FROM orders WHERE o_custkey <> 20
               UNION ALL SELECT -1 - o_orderkey, o_orderstatus FROM orders WHERE o_custkey = 21)
    SELECT o_orderkey, CASE WHEN b.s IS NULL THEN 'only in first' WHEN o_orderstatus IS NULL THEN 'only in second'
                            ELSE 'differs' END AS status
    FROM (SELECT o_orderkey, o_orderstatus FROM orders) a FULL JOIN b USING (o_orderkey)
    WHERE o_orderstatus IS DISTINCT FROM b.s
    """
)
def keyed_compare(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey")
    status = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("X")).otherwise(F.col("o_orderstatus"))
    other = (
        orders.where("o_custkey <> 20")
        .select("o_orderkey", status.alias("o_orderstatus"))
        .unionByName(
            orders.where("o_custkey = 21").select((-1 - F.col("o_orderkey")).alias("o_orderkey"), "o_orderstatus")
        )
    )
    return joins.compare_keyed(orders, other, ["o_orderkey"], ["o_orderstatus"])
