"""Queries on feature tables and regression models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinspark.catalog import query
from basinspark.catalog.inputs import LINE_CENTS, LINE_MONTH, ORDER_CENTS, ORDER_MONTH, line_months, order_months, table
from basinspark.functions.calendar import month_start
from basinspark.functions.numbers import mean
from basinspark.operators import features, models
from basinspark.operators.shape import to_wide
from basinspark.operators.windows import lag_lead

TRAIN, TEST = ("1995-01-01", "1998-12-31"), ("1999-01-01", "2001-12-31")
INPUTS = ["x", "d", "t"]


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return line_months(spark, folder).select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.col("l_shipdate").cast("date").alias("day"),
        F.col("l_quantity").alias("x"),
        (F.col("l_discount") * 100).alias("d"),
        (F.col("l_tax") * 100).alias("t"),
        (F.col("l_extendedprice") / 1000).alias("y"),
    )


def _parts(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return features.date_split(df, "day", TRAIN, TEST)


@query(
    """
    WITH m AS (SELECT avg(l_quantity) AS mx, stddev_pop(l_quantity) AS sx, avg(l_linenumber) AS ml,
                      stddev_pop(l_linenumber) AS sl FROM lineitem WHERE l_shipdate <= '1998-12-31')
    SELECT l_orderkey, l_partkey, l_linenumber, round((l_quantity - mx) / sx, 6) AS x_scaled,
           round((l_linenumber - ml) / sl, 6) AS l_linenumber_scaled, 0.0::DOUBLE AS constant_scaled,
           l_quantity AS x
    FROM lineitem, m
    """
)
def standardised_features(spark: SparkSession, folder: str) -> DataFrame:
    """All lines scaled by the moments of the training period; a constant column has scale 1."""
    lines = _lines(spark, folder).withColumn("constant", F.lit(7.0))
    columns = ["x", "l_linenumber", "constant"]
    scaler = features.fit_scaler(_parts(lines)[0], columns)
    return scaler.scale(lines, suffix="_scaled").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "x",
        *[F.round(f"{c}_scaled", 6).alias(f"{c}_scaled") for c in columns],
    )


@query(
    f"""
    WITH x AS (
        SELECT {LINE_MONTH}, CAST(sum({LINE_CENTS}) FILTER (l_returnflag = 'A') AS DOUBLE) / count(*) FILTER (l_returnflag = 'A') AS a,
               CAST(sum({LINE_CENTS}) FILTER (l_returnflag = 'N') AS DOUBLE) / count(*) FILTER (l_returnflag = 'N') AS n,
               CAST(sum({LINE_CENTS}) FILTER (l_returnflag = 'R') AS DOUBLE) / count(*) FILTER (l_returnflag = 'R') AS r,
               CAST(sum(l_linenumber) AS DOUBLE) / count(*) AS target
        FROM lineitem GROUP BY ALL
    ), lagged AS (
        SELECT *, lag(a) OVER w AS "a_mo-1", lag(n) OVER w AS "n_mo-1", lag(r) OVER w AS "r_mo-1" FROM x WINDOW w AS (ORDER BY year, month)
    )
    SELECT year, month, a, n, r, "a_mo-1", "n_mo-1", "r_mo-1", target, make_date(year, month, 1) AS month_start,
           CASE WHEN year <= 1998 THEN 'train' ELSE 'test' END AS part
    FROM lagged WHERE COLUMNS(['a', 'n', 'r', 'a_mo-1', 'n_mo-1', 'r_mo-1']) IS NOT NULL
    """
)
def features_split(spark: SparkSession, folder: str) -> DataFrame:
    """Wide features of all months with lags, targets of the same months, and the split by date."""
    lines, names = line_months(spark, folder), ["a", "n", "r"]
    wide = to_wide(lines.withColumn("name", F.lower("l_returnflag")), ["year", "month"], "name", names, "cents")
    targets = lines.groupBy("year", "month").agg(mean("l_linenumber").alias("target"))
    table = features.training_table(lag_lead(wide, [], ["year", "month"], names, lag=1), targets)
    parts = features.date_split(table, "month_start", TRAIN, TEST)
    return parts[0].withColumn("part", F.lit("train")).unionByName(parts[1].withColumn("part", F.lit("test")))


@query(
    """
    WITH lines AS (SELECT l_quantity AS x, l_extendedprice / 1000 AS y, l_shipdate <= '1998-12-31' AS train FROM lineitem),
    fit AS (SELECT regr_slope(y, x) AS s, regr_intercept(y, x) AS i, avg(y) AS my, stddev_pop(y) AS sy FROM lines WHERE train),
    test AS (SELECT (y - my) / sy AS zy, (s * x + i - my) / sy AS zp FROM lines, fit WHERE NOT train),
    scores AS (SELECT avg((zy - zp) * (zy - zp)) AS mse, 1 - avg((zy - zp) * (zy - zp)) / var_pop(zy) AS r2 FROM test)
    SELECT unnest(['y', 'mean']) AS target, round(mse, 6) AS mse, round(r2, 6) AS r2 FROM scores
    """
)
def linear_fit_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Least squares on standardised lines of the training period, judged on the hold-out period."""
    train, test = _parts(_lines(spark, folder))
    scaler = features.fit_scaler(train, ["x", "y"])
    fitted = models.fit_linear(models.assemble(scaler.scale(train), ["x"]), ["y"])
    inputs = models.assemble(scaler.scale(test), ["x"]).withColumnRenamed("y", "observed")
    scores = models.holdout_scores(fitted.predict(inputs), {"observed": "y"})
    return scores.select(
        F.when(F.col("target") == "observed", "y").otherwise(F.col("target")).alias("target"),
        F.round("mse", 6).alias("mse"),
        F.round("r2", 6).alias("r2"),
    )


@query()
def forest_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """A forest of 100 trees of depth 30 on three features, its price for every hold-out line."""
    train, test = _parts(_lines(spark, folder))
    fitted = models.fit_forest(models.assemble(train, INPUTS), ["y"])
    scored = fitted.predict(models.assemble(test.drop("y"), INPUTS))
    return scored.select("l_orderkey", "l_partkey", "l_linenumber", "y")


@query()
def kernel_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """The kernel model on three scaled features, its price for every hold-out line."""
    train, test = _parts(_lines(spark, folder))
    scaler = features.fit_scaler(train, [*INPUTS, "y"])
    fitted = models.fit_kernel(models.assemble(scaler.scale(train), INPUTS), ["y"], models.KernelFeatures(n_inputs=len(INPUTS)))
    scored = fitted.predict(models.assemble(scaler.scale(test.drop("y"), INPUTS), INPUTS))
    return scaler.unscale(scored, ["y"]).select("l_orderkey", "l_partkey", "l_linenumber", "y")


@query()
def ensemble_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Kernel, forest and linear model on the same scaled inputs, every hold-out line in the units of the target."""
    train, test = _parts(_lines(spark, folder))
    ensemble = models.fit_ensemble(train, INPUTS, ["y"], features.fit_scaler(train, INPUTS), features.fit_scaler(train, ["y"]))
    return ensemble.predict_all(test.drop("y"), ["l_orderkey", "l_partkey", "l_linenumber"])


# A step function of two features with few values, which a forest of any seed learns exactly.
_STEPS = "CASE WHEN l_linenumber <= 2 THEN 10.0 WHEN l_linenumber <= 5 THEN 25.0 ELSE 40.0 END + CASE WHEN l_tax >= 0.05 THEN 100.0 ELSE 0.0 END"


@query(f"SELECT l_orderkey, l_partkey, l_linenumber, CAST({_STEPS} AS DOUBLE) AS y FROM lineitem WHERE l_shipdate >= '1999-01-01'")
def forest_steps(spark: SparkSession, folder: str) -> DataFrame:
    """A forest of full depth on a step function, scored on the hold-out lines."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("day"),
        F.col("l_linenumber").cast("double").alias("n"), F.col("l_tax").cast("double").alias("t"), F.expr(_STEPS).cast("double").alias("y"),
    )
    train, test = _parts(lines)
    fitted = models.fit_forest(models.assemble(train, ["n", "t"]), ["y"])
    scored = fitted.predict(models.assemble(test.drop("y"), ["n", "t"]))
    return scored.select("l_orderkey", "l_partkey", "l_linenumber", F.round("y", 6).alias("y"))


_JOINT = ["CASE WHEN l_linenumber <= 3 THEN 5.0 ELSE 8.0 END", "CASE WHEN l_linenumber <= 5 THEN -40.0 ELSE 60.0 END", "CASE WHEN l_tax >= 0.03 THEN 700.0 ELSE -200.0 END"]


@query(
    f"""
    SELECT l_orderkey, l_partkey, l_linenumber, {", ".join(f"CAST({step} AS DOUBLE) AS y{i}" for i, step in enumerate(_JOINT))}
    FROM lineitem WHERE l_shipdate >= '1999-01-01'
    """
)
def forest_joint_targets(spark: SparkSession, folder: str) -> DataFrame:
    """One forest of three targets, whose trees must find the steps of each, scored on the hold-out lines."""
    targets = [f"y{i}" for i in range(len(_JOINT))]
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("day"), F.col("l_linenumber").cast("double").alias("n"),
        F.col("l_tax").cast("double").alias("t"), *[F.expr(step).cast("double").alias(name) for name, step in zip(targets, _JOINT, strict=True)],
    )
    train, test = _parts(lines)
    fitted = models.fit_forest(models.assemble(train, ["n", "t"]), targets, trees=20)
    scored = fitted.predict(models.assemble(test.drop(*targets), ["n", "t"]))
    return scored.select("l_orderkey", "l_partkey", "l_linenumber", *[F.round(name, 6).alias(name) for name in targets])


@query()
def kernel_search(spark: SparkSession, folder: str) -> DataFrame:
    """Both length scales of the kernel that make the prices of the training lines most likely, beside those of the start."""
    train, _ = _parts(_lines(spark, folder))
    scaler = features.fit_scaler(train, [*INPUTS, "y"])
    rows = models.assemble(scaler.scale(train), INPUTS)
    start = models.KernelFeatures(n_inputs=len(INPUTS), n_features=100)
    found = models.search_kernel(rows, ["y"], start, passes=2, points=3)
    return spark.createDataFrame(
        [(name, float(k.matern_length), float(k.quadratic_length), models.fit_likelihood(rows, ["y"], k)) for name, k in (("start", start), ("found", found))],
        "kernel string, matern_length double, quadratic_length double, log_likelihood double",
    )


@query("SELECT l_orderkey, l_partkey, l_linenumber, true AS near FROM lineitem WHERE l_shipdate >= '1999-01-01'")
def kernel_near_label(spark: SparkSession, folder: str) -> DataFrame:
    """The kernel model on a smooth label: every hold-out line is within 0.15 of it, a tenth of its range of 1.5."""
    lines = _lines(spark, folder).withColumn("y", F.sin(F.col("x") / 12) * 0.75)
    train, test = _parts(lines)
    scaler = features.fit_scaler(train, ["x", "y"])
    kernel = models.KernelFeatures(n_inputs=1)
    fitted = models.fit_kernel(models.assemble(scaler.scale(train), ["x"]), ["y"], kernel)
    scored = fitted.predict(models.assemble(scaler.scale(test.withColumnRenamed("y", "label"), ["x"]), ["x"]))
    near = F.abs(F.col("y") - F.col("label")) < 0.15
    return scaler.unscale(scored, ["y"]).select("l_orderkey", "l_partkey", "l_linenumber", near.alias("near"))


@query(
    """
    WITH lines AS (SELECT l_quantity AS x, l_extendedprice / 1000 AS y, l_shipdate <= '1998-12-31' AS train FROM lineitem),
    fit AS (SELECT regr_slope(y, x) AS s, regr_intercept(y, x) AS i FROM lines WHERE train)
    SELECT model, count(*) AS n, CASE WHEN model = 'LR' THEN round(sum(s * x + i) / count(*), 6) END AS mean_linear
    FROM lines, fit, (SELECT unnest(['GP', 'RF', 'LR']) AS model) WHERE NOT train GROUP BY model
    """
)
def ensemble_linear_mean(spark: SparkSession, folder: str) -> DataFrame:
    """Kernel, forest and linear model on the same scaled input in the units of the target: rows, and the linear mean."""
    train, test = _parts(_lines(spark, folder))
    ensemble = models.fit_ensemble(train, ["x"], ["y"], features.fit_scaler(train, ["x"]), features.fit_scaler(train, ["y"]))
    scored = ensemble.predict_all(test.drop("y"), ["l_orderkey", "l_partkey", "l_linenumber"])
    means = scored.where("y IS NOT NULL").groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean"))
    return means.select("model", "n", F.when(F.col("model") == "LR", F.round("mean", 6)).alias("mean_linear"))


@query(
    f"""
    SELECT {ORDER_MONTH}, make_date(year(o_orderdate), month(o_orderdate), 1) AS month_start,
           CAST(sum({ORDER_CENTS}) AS DOUBLE) / count(*) AS target
    FROM orders GROUP BY ALL
    """
)
def monthly_targets(spark: SparkSession, folder: str) -> DataFrame:
    targets = order_months(spark, folder).groupBy("year", "month").agg(mean("cents").alias("target"))
    return targets.withColumn("month_start", month_start("year", "month"))
