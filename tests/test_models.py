"""Scaling, training tables, models and the flows that use them."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from basinspark.operators import features, models
from basinspark.operators.distinct import by_distinct
from basinspark.plans.forecast import forecast, published_by_lead
from basinspark.plans.training import train
from basinspark.plans.verification import verify
from basinspark.schemas import FEATURES, PREDICTORS, TARGETS


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.fixture(scope="module")
def table(spark):
    source = np.random.default_rng(4)
    frame = pd.DataFrame(source.normal(size=(300, 3)), columns=["a", "b", "c"])
    frame["twin"] = frame["a"] * 2
    frame["y 1"] = 2 * frame.a - frame.b + 3 + source.normal(0, 0.1, 300)
    frame["y2"] = np.sin(frame.a) + frame.c**2
    frame["id"] = range(300)
    return frame, spark.createDataFrame(frame).repartition(5)


def test_scaler(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0), (None, 7.0)], "`v [mm]` double, constant double")
    scaler = features.fit_scaler(df, ["v [mm]", "constant"])
    assert scaler.means == {"v [mm]": 2.0, "constant": 7.0} and scaler.scales == {"v [mm]": 1.0, "constant": 1.0}
    scaled = scaler.scale(df)
    assert rows(scaled) == [(-1.0, 0.0), (1.0, 0.0), (None, 0.0)]
    assert rows(scaler.unscale(scaled)) == rows(df)


def test_date_split_is_inclusive(spark):
    days = [dt.date(2004, 12, 1), dt.date(2004, 12, 2), dt.date(2005, 1, 1), dt.date(2011, 1, 1), dt.date(2011, 2, 1)]
    df = spark.createDataFrame([(d,) for d in days], "day date")
    a, b = features.date_split(df, "day", ("1979-01-01", "2004-12-01"), ("2005-01-01", "2011-01-01"))
    assert [r.day for r in a.collect()] == days[:1] and [r.day for r in b.collect()] == days[2:4]


def test_linear_fit_equals_least_squares(table):
    frame, df = table
    names = ["a", "b", "c", "twin"]
    fitted = models.fit_linear(models.assemble(df, names), ["y 1", "y2"])
    x = frame[names] - frame[names].mean()
    expected = np.linalg.lstsq(x, frame[["y 1", "y2"]] - frame[["y 1", "y2"]].mean(), rcond=None)[0]
    assert np.allclose(fitted.coefficients, expected, atol=1e-8)
    scored = fitted.predict(models.assemble(df.drop("y 1", "y2"), names)).toPandas().sort_values("id")
    assert np.allclose(scored[["y 1", "y2"]], x @ expected + frame[["y 1", "y2"]].mean().to_numpy(), atol=1e-8)


def test_rows_with_missing_targets_are_left_out(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 3.0), (9.0, None)], "a double, y double")
    fitted = models.fit_linear(models.assemble(df, ["a"]), ["y"])
    assert fitted.coefficients[0, 0] == pytest.approx(2) and fitted.intercepts[0] == pytest.approx(1)
    with pytest.raises(ValueError, match="no rows"):
        models.fit_linear(models.assemble(df.where("a > 5"), ["a"]), ["y"])


def test_random_features_recover_the_kernel():
    kernel = models.KernelFeatures(2, 200_000, matern_length=1.5, quadratic_length=0.8, quadratic_alpha=2.0)
    x = np.array([[0.0, 0.0], [0.3, -0.2], [1.0, 0.5], [-2.0, 1.0]])
    distance = np.sqrt(((x[:, None] - x[None, :]) ** 2).sum(-1))
    root = np.sqrt(3) * distance / 1.5
    exact = (1 + root) * np.exp(-root) * (1 + distance**2 / (2 * 2.0 * 0.8**2)) ** -2.0
    waves = kernel.waves(x)
    assert np.abs(waves @ waves.T - exact).max() < 0.01
    assert (kernel.waves(x) == waves).all()


def test_kernel_fit_equals_ridge_on_its_features(table):
    frame, df = table
    kernel = models.KernelFeatures(3, 60, matern_length=2.0, quadratic_length=2.0)
    names = ["a", "b", "c"]
    fitted = models.fit_kernel(models.assemble(df, names), ["y 1", "y2"], kernel)
    z = kernel.waves(frame[names].to_numpy())
    expected = np.linalg.solve(z.T @ z + 0.1 * np.eye(60), z.T @ frame[["y 1", "y2"]].to_numpy())
    scored = fitted.predict(models.assemble(df.drop("y 1", "y2"), names)).toPandas().sort_values("id")
    assert np.allclose(scored[["y 1", "y2"]], z @ expected, atol=1e-6)


def exact_kernel(x, matern, quadratic, alpha):
    distance = np.sqrt(((x[:, None] - x[None, :]) ** 2).sum(-1))
    root = np.sqrt(3) * distance / matern
    return (1 + root) * np.exp(-root) * (1 + distance**2 / (2 * alpha * quadratic**2)) ** -alpha


def test_likelihood_equals_that_of_the_whole_matrix(spark):
    source = np.random.default_rng(8)
    x, y = source.normal(size=(90, 2)), source.normal(size=(90, 2))
    df = models.assemble(spark.createDataFrame(pd.DataFrame(np.hstack([x, y]), columns=["a", "b", "y", "z"])), ["a", "b"])
    kernel = models.KernelFeatures(2, 40, matern_length=1.5)
    found = models.log_likelihood(models._products(df, ["y", "z"], kernel), 2, 0.1)
    z = kernel.waves(x)
    matrix = z @ z.T + 0.1 * np.eye(90)
    direct = -0.5 * (np.trace(y.T @ np.linalg.solve(matrix, y)) + 2 * (np.linalg.slogdet(matrix)[1] + 90 * np.log(2 * np.pi)))
    assert found == pytest.approx(direct, rel=1e-8)


def test_lengths_are_recovered_by_likelihood(spark):
    """Targets drawn with known lengths from the exact kernel, not from the random features."""
    source = np.random.default_rng(12)
    x = source.uniform(-2, 2, size=(500, 1))
    for matern, quadratic, search in ((0.7, 100.0, "matern_length"), (100.0, 0.6, "quadratic_length")):
        covariance = exact_kernel(x, matern, quadratic, 1.0) + 1e-8 * np.eye(500)
        y = np.linalg.cholesky(covariance) @ source.normal(size=(500, 24)) + np.sqrt(0.1) * source.normal(size=(500, 24))
        names = [f"y{i}" for i in range(24)]
        df = models.assemble(spark.createDataFrame(pd.DataFrame(np.hstack([x, y]), columns=["a", *names])), ["a"]).cache()
        start = models.KernelFeatures(1, 1000, matern_length=matern if search != "matern_length" else 2.5, quadratic_length=quadratic if search != "quadratic_length" else 2.5)
        found = models.search_kernel(df, names, start, 0.1, (search,), passes=4)
        assert getattr(found, search) == pytest.approx({"matern_length": matern, "quadratic_length": quadratic}[search], rel=0.2)
        df.unpersist()


def test_holdout_scores(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0, 5.0), (3.0, 3.0, 7.0, 7.0)], "a double, pa double, b double, pb double")
    found = {r.target: (r.mse, r.r2) for r in models.holdout_scores(df, {"a": "pa", "b": "pb"}).collect()}
    assert found == {"a": (0.5, 0.5), "b": (0.0, 1.0), "mean": (0.25, 0.75)}


def test_ensemble_scores_saves_and_loads(spark, table, tmp_path):
    _, df = table
    names, targets = ["a", "b", "c"], ["y 1", "y2"]
    ensemble = models.fit_ensemble(
        df, names, targets, features.fit_scaler(df, names), features.fit_scaler(df, targets),
        kernel=models.KernelFeatures(3, 80, 2.0, 2.0), trees=5,
    )
    scored = ensemble.predict_all(df.drop(*targets), ["id"])
    assert scored.columns == ["id", "y 1", "y2", "model"]
    assert rows(scored.groupBy("model").count()) == [("GP", 300), ("LR", 300), ("RF", 300)]
    errors = df.select("id", F.col("`y 1`").alias("truth")).join(scored, "id").groupBy("model").agg(F.avg(F.abs(F.col("truth") - F.col("`y 1`"))).alias("e"))
    assert {r.model: r.e < 1.0 for r in errors.collect()} == {"GP": True, "LR": True, "RF": True}
    with pytest.raises(ValueError, match="Unknown model 'NN'"):
        ensemble.predict(df, "NN", ["id"])
    models.save_ensemble(spark, ensemble, str(tmp_path / "saved"))
    again = models.load_ensemble(spark, str(tmp_path / "saved")).predict_all(df.drop(*targets), ["id"])
    assert rows(again) == rows(scored)


def run_table(spark, months):
    source = np.random.default_rng(9)
    records = []
    for year, month in months:
        for run in (1, 2):
            for name in PREDICTORS:
                lake, surface, component = name.split("_", 2)
                records.append((year * 1000000 + month * 10000 + run, year, month, lake, surface, component, float(source.normal(50, 9))))
    return spark.createDataFrame(
        records, "cfs_run long, year int, month int, lake string, surface_type string, component string, `value [mm]` double"
    )


def test_feature_matrix_order_and_incomplete_rows(spark):
    table = run_table(spark, [(2025, 5)])
    broken = table.where("NOT (cfs_run % 10 = 2 AND lake = 'erie' AND component = 'evaporation' AND surface_type = 'land')")
    matrix = features.feature_matrix(broken)
    assert matrix.columns == ["cfs_run", "year", "month", *FEATURES]
    assert [r.cfs_run % 10 for r in matrix.collect()] == [1] and matrix.first()["month_5"] == 1


def test_training_forecast_and_verification(spark, tmp_path):
    months = [(2020 + n // 12, n % 12 + 1) for n in range(48)]
    runs = run_table(spark, months)
    matrix = features.feature_matrix(runs).groupBy("year", "month").agg(*[F.avg(n).alias(n) for n in FEATURES])
    signal = F.col("superior_lake_precipitation") - F.col("erie_land_evaporation")
    targets = matrix.select("year", "month", *[(signal * (i + 1) + i).alias(t) for i, t in enumerate(TARGETS)])
    ensemble, scores = train(
        matrix, targets, FEATURES, TARGETS, ("2020-01-01", "2023-06-01"), ("2023-07-01", "2023-12-01"),
        kernel=models.KernelFeatures(36, 50, 10.0, 10.0), trees=1,
    )
    linear = {r.target: r for r in scores.where("model = 'LR'").collect()}
    assert linear["mean"].r2 == pytest.approx(1.0) and linear["mean"].mse == pytest.approx(0.0, abs=1e-9)
    assert set(linear) == {"mean", *[f"{t}_obs" for t in TARGETS]}

    ensemble.models = {"LR": ensemble.models["LR"]}
    result = forecast(runs, ensemble, dt.date(2023, 9, 26))
    assert result.rows.count() == 3 * 2 * 16
    table = result.published.collect()
    assert len(table) == 3 * 16 and {(r.current_year, r.current_month) for r in table} == {(2023, 10)}
    one = result.published.where("lake = 'erie' AND component = 'cnbs' AND forecast_month = 10").first()
    assert one["value [cms]"] == pytest.approx(one["value [mm]"] / 1000 * 25655e6 / (31 * 86400), abs=0.02)
    leads = published_by_lead(result.published)
    assert leads.columns[-3:] == ["month_1", "month_2", "month_3"] and leads.count() == 16
    result.write(str(tmp_path / "tables"))
    assert spark.read.parquet(str(tmp_path / "tables" / "cnbs_forecast_model_mean")).count() == 48

    wide = ensemble.predict_all(features.feature_matrix(runs), ["cfs_run", "year", "month"])
    long = targets.unpivot(["year", "month"], [f"`{t}`" for t in TARGETS], "name", "observed").select(
        "year", "month", F.split("name", "_")[0].alias("lake"), F.split("name", "_")[1].alias("component"), "observed"
    )
    skill = {r.group: r for r in verify(wide, long).collect()}
    assert set(skill) == {"All", "Components", "Precipitation", "Evaporation", "Runoff", "CNBS"}
    assert skill["All"].n_pairs == 48 * 16 and skill["All"].r2 == pytest.approx(1.0, abs=1e-3)


def test_equal_features_are_multiplied_once(spark, monkeypatch):
    """Sums of products of rows that occur again, joined as long as few are held, against those of all rows."""
    source = np.random.default_rng(5)
    frame = pd.DataFrame({"a": source.integers(0, 4, 3000) / 3, "b": source.integers(0, 3, 3000) / 7, "y": source.normal(size=3000), "z": source.normal(size=3000)})
    df = models.assemble(spark.createDataFrame(frame).repartition(2), ["a", "b"])
    kernel = models.KernelFeatures(n_inputs=2, n_features=7)
    for most in (10_000, 5):
        monkeypatch.setattr(models, "FOLDED_ROWS", most)
        for found, z in zip(models._many_products(df, ["y", "z"], [kernel, None]), (kernel.waves(frame[["a", "b"]].to_numpy()), frame[["a", "b"]].to_numpy()), strict=True):
            whole = np.hstack([np.ones((3000, 1)), z, frame[["y", "z"]].to_numpy()])
            assert np.allclose(found, whole.T @ whole, rtol=1e-10, atol=1e-9)


def test_equal_rows_are_computed_once(spark):
    """Every row has its result, whether it is new, kept, or past what a task keeps; few rows are computed."""
    seen = spark.sparkContext.accumulator(0)

    def doubled(x):
        seen.add(len(x))
        return x * 2

    values = F.array((F.col("id") % 50).cast("double"), F.lit(1.0))
    df = spark.range(60_000, numPartitions=2)
    for most, limit in ((100, 100), (10, 2000)):
        before = seen.value
        wrong = df.withColumn("out", by_distinct(doubled, most)(values)).where("out[0] <> 2 * (id % 50) OR out[1] <> 2 OR size(out) <> 2")
        assert wrong.count() == 0 and 0 < seen.value - before <= limit
