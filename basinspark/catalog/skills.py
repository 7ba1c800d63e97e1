"""Queries on verification: skill scores, CRPS and plot feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinspark.catalog import query
from basinspark.catalog.inputs import (
    EVENT_RUN,
    LINE_CENTS,
    LINE_MONTH,
    ORDER_CENTS,
    ORDER_MONTH,
    event_runs,
    line_months,
    linear_quantile,
    order_months,
    table,
)
from basinspark.functions.numbers import mean
from basinspark.operators import skill
from basinspark.operators.ensemble import ensemble_mean
from basinspark.operators.moments import store_moments, stored_skill
from basinspark.operators.shape import to_wide
from basinspark.session import fresh_folder

DIGITS = 6

_PAIRS = """
    SELECT l_returnflag AS model, l_linestatus AS variable, l_quantity AS p, l_extendedprice / 2000 AS o
    FROM lineitem WHERE l_tax <> 0.08::DOUBLE
"""


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("model"),
        F.col("l_linestatus").alias("variable"),
        F.when(F.col("l_tax") != 0.08, F.col("l_quantity")).alias("pred"),
        (F.col("l_extendedprice") / 2000).alias("obs"),
    )


def _scores(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.round(name, DIGITS) for name in skill.SCORES})


_RAW = f"""
    count(*) AS n_pairs, round(sqrt(avg((p - o) * (p - o))) / stddev_pop(o), {DIGITS}) AS rmse,
    round(1 - avg((p - o) * (p - o)) / var_pop(o), {DIGITS}) AS r2
"""
_STANDARD = f"""
    {_RAW}, round(avg(p - o) / stddev_pop(o), {DIGITS}) AS bias,
    round(var_pop(p) / var_pop(o), {DIGITS}) AS variance, round(avg(abs(p - o)) / stddev_pop(o), {DIGITS}) AS crps
"""
_RAW_ALL = f"""
    {_RAW}, round(avg(p - o), {DIGITS}) AS bias, round(var_pop(p), {DIGITS}) AS variance,
    round(avg(abs(p - o)), {DIGITS}) AS crps
"""


@query(f"SELECT model, {_RAW_ALL} FROM ({_PAIRS}) GROUP BY model")
def skill_raw(spark: SparkSession, folder: str) -> DataFrame:
    return _scores(skill.skill(_pairs(spark, folder), ["model"]))


@query(f"SELECT model, {_RAW_ALL} FROM ({_PAIRS}) GROUP BY model")
def skill_by_lots(spark: SparkSession, folder: str) -> DataFrame:
    """Scores from stored moments after three lots of lines, of which the second comes twice and the third mends a part."""
    path = fresh_folder(spark, "moments")
    pairs = table(spark, folder, "lineitem").select(
        (F.col("l_linenumber") % 3).alias("lot"), F.col("l_returnflag").alias("model"), F.when(F.col("l_tax") != 0.08, F.col("l_quantity")).alias("pred"), (F.col("l_extendedprice") / 2000).alias("obs")
    )
    for lot in (pairs.where("lot = 0"), pairs.where("lot = 1"), pairs.where("lot = 1"), pairs.where("lot = 2 AND obs > 10"), pairs.where("lot = 2")):
        store_moments(spark, path, lot, "lot", ["model"], centre=25.0)
    return _scores(stored_skill(spark, path, ["model"]))


@query(f"SELECT model, {_STANDARD} FROM ({_PAIRS}) GROUP BY model")
def skill_std(spark: SparkSession, folder: str) -> DataFrame:
    return _scores(skill.skill(_pairs(spark, folder), ["model"], scaling="obs_std"))


@query(
    f"""
    WITH m AS (
        SELECT model, avg(p) AS mp, avg(o) AS mo, stddev_pop(p) AS sp, stddev_pop(o) AS so FROM ({_PAIRS}) GROUP BY model
    ), z AS (SELECT model, (p - mp) / sp AS p, (o - mo) / so AS o FROM ({_PAIRS}) JOIN m USING (model))
    SELECT model, count(*) AS n_pairs, round(sqrt(avg((p - o) * (p - o))), {DIGITS}) AS rmse,
           round(1 - avg((p - o) * (p - o)), {DIGITS}) AS r2, abs(round(avg(p - o), {DIGITS})) AS bias,
           round(var_pop(p) / var_pop(o), {DIGITS}) AS variance, round(avg(abs(p - o)), {DIGITS}) AS crps
    FROM z GROUP BY model
    """
)
def skill_own(spark: SparkSession, folder: str) -> DataFrame:
    scores = _scores(skill.skill(_pairs(spark, folder), ["model"], scaling="own"))
    return scores.withColumn("bias", F.abs("bias"))


@query(
    f"""
    SELECT variable, {_STANDARD} FROM ({_PAIRS}) GROUP BY variable
    UNION ALL SELECT 'overall', {_STANDARD} FROM ({_PAIRS})
    """
)
def skill_by_variable(spark: SparkSession, folder: str) -> DataFrame:
    pairs = _pairs(spark, folder)
    single = skill.skill(pairs, ["variable"], scaling="obs_std")
    overall = skill.skill(pairs, [], scaling="obs_std").withColumn("variable", F.lit("overall"))
    return _scores(single.unionByName(overall))


_VARIABLES = [f"{lake}_{part}" for lake in "ANR" for part in "FO"]
_GROUPS = {"All": _VARIABLES, "F": [v for v in _VARIABLES if v[2] == "F"], "O": [v for v in _VARIABLES if v[2] == "O"]}


@query(
    f"""
    WITH cells AS (
        SELECT l_shipdate AS day, CAST(l_linenumber % 3 AS VARCHAR) AS model, l_returnflag || '_' || l_linestatus AS variable,
               CAST(sum({LINE_CENTS}) AS DOUBLE) / count(*) / 200000 AS p, avg(l_quantity) AS o
        FROM lineitem GROUP BY ALL
    ), members AS (
        SELECT *, 'All' AS "group", 6 AS needed FROM cells
        UNION ALL SELECT *, right(variable, 1), 3 FROM cells
    ), whole AS (
        SELECT * FROM members QUALIFY count(*) OVER (PARTITION BY day, model, "group") = needed
    )
    SELECT model, "group", {_RAW_ALL} FROM whole GROUP BY model, "group"
    """
)
def skill_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Overlapping groups of variables; a day counts for a group only when all its variables are there."""
    lines = line_months(spark, folder).withColumns(
        {
            "variable": F.concat("l_returnflag", F.lit("_"), "l_linestatus"),
            "model": (F.col("l_linenumber") % 3).cast("string"),
        }
    )
    keys = ["l_shipdate", "model"]
    cells = lines.groupBy(*keys, "variable").agg(
        (mean("cents") / 200000).alias("p"), F.avg("l_quantity").alias("o")
    )
    wide = cells.groupBy(*keys).agg(
        *[F.max(F.when(F.col("variable") == v, F.col("p"))).alias(v) for v in _VARIABLES],
        *[F.max(F.when(F.col("variable") == v, F.col("o"))).alias(f"{v}_obs") for v in _VARIABLES],
    )
    pairs = {v: (v, f"{v}_obs") for v in _VARIABLES}
    return _scores(skill.skill_groups(wide, pairs, _GROUPS, ["model"], digits=None))


def _crps_sql(keys: str, source: str) -> str:
    return f"""
        WITH members AS ({source}), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY x) AS i,
                   count(*) OVER (PARTITION BY {keys}) AS m FROM members
        )
        SELECT {keys}, count(*) AS n_members,
               round(avg(abs(x - y)) - sum(x * (2 * i - m - 1)) / (count(*) * count(*)), 9) AS crps
        FROM ranked GROUP BY {keys}
    """


@query(_crps_sql("run", f"SELECT {EVENT_RUN} AS run, value AS x, ({EVENT_RUN} % 97)::DOUBLE AS y FROM events"))
def crps_members(spark: SparkSession, folder: str) -> DataFrame:
    members = event_runs(spark, folder).withColumn("observed", (F.col("run") % 97).cast("double"))
    return skill.crps(members, ["run"], "value", "observed").withColumn("crps", F.round("crps", 9))


@query(_crps_sql("event_type", "SELECT event_type, value AS x, length(event_type)::DOUBLE AS y FROM events"))
def crps_large_ensembles(spark: SparkSession, folder: str) -> DataFrame:
    """Few observations with very many members each, ranked across tasks."""
    members = table(spark, folder, "events").withColumn("observed", F.length("event_type").cast("double"))
    scores = skill.crps(members, ["event_type"], "value", "observed", small_group=1000)
    return scores.withColumn("crps", F.round("crps", 9))


@query("SELECT event_id, 1::BIGINT AS n_members, abs(value - 25) AS crps FROM events")
def crps_single_member(spark: SparkSession, folder: str) -> DataFrame:
    return skill.crps(
        table(spark, folder, "events").withColumn("observed", F.lit(25.0)), ["event_id"], "value", "observed"
    )


@query(
    f"""
    WITH w AS (
        SELECT {LINE_MONTH}, l_linenumber,
               CAST(sum({LINE_CENTS}) FILTER (l_returnflag = 'A') AS DOUBLE) / count(*) FILTER (l_returnflag = 'A') AS "A",
               CAST(sum({LINE_CENTS}) FILTER (l_returnflag = 'N') AS DOUBLE) / count(*) FILTER (l_returnflag = 'N') AS "N",
               CAST(sum({LINE_CENTS}) FILTER (l_returnflag = 'R') AS DOUBLE) / count(*) FILTER (l_returnflag = 'R') AS "R"
        FROM lineitem GROUP BY ALL
    )
    SELECT year, month, {linear_quantile('"A"', 0.5)} AS "A", {linear_quantile('"N"', 0.5)} AS "N", {linear_quantile('"R"', 0.5)} AS "R",
           any_value(t) AS observed
    FROM w JOIN (SELECT {ORDER_MONTH}, CAST(sum({ORDER_CENTS}) AS BIGINT) AS t FROM orders GROUP BY ALL)
    USING (year, month) GROUP BY year, month HAVING count("A") > 0 AND count("N") > 0 AND count("R") > 0
    """
)
def predictor_medians(spark: SparkSession, folder: str) -> DataFrame:
    wide = to_wide(line_months(spark, folder), ["year", "month", "l_linenumber"], "l_returnflag", ["A", "N", "R"], "cents")
    observed = order_months(spark, folder).groupBy("year", "month").agg(F.sum("cents").alias("observed"))
    return skill.predictor_medians(wide, ["year", "month"], ["A", "N", "R"], observed)


@query(
    f"""
    WITH d AS (
        SELECT l_returnflag AS series, l_linestatus AS model, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
               {LINE_CENTS} AS cents
        FROM lineitem WHERE l_shipdate >= '1997-01-01' AND l_shipdate < '1999-02-01'
    ), band AS (
        SELECT series, date, {linear_quantile("cents", 0.025)} AS lower, {linear_quantile("cents", 0.975)} AS upper
        FROM d GROUP BY series, date
    )
    SELECT series, date, model, CAST(sum(cents) AS DOUBLE) / count(*) AS model_mean, any_value(lower) AS lower,
           any_value(upper) AS upper
    FROM d JOIN band USING (series, date) GROUP BY series, date, model
    """
)
def plot_feed(spark: SparkSession, folder: str) -> DataFrame:
    lines = line_months(spark, folder).withColumnsRenamed({"l_returnflag": "series", "l_linestatus": "model"})
    return skill.plot_feed(lines, "series", "model", "year", "month", "cents", "1997-01-01", "1999-01-01")


@query(
    f"""
    SELECT {LINE_MONTH}, l_returnflag AS model, round_even(CAST(sum({LINE_CENTS}) AS DOUBLE) / count(*), 3) AS mean_cents
    FROM lineitem GROUP BY ALL
    """
)
def monthly_predictions(spark: SparkSession, folder: str) -> DataFrame:
    lines = line_months(spark, folder).withColumnRenamed("l_returnflag", "model")
    return ensemble_mean(lines, ["year", "month", "model"], {"cents": "mean_cents"}, digits=3)
