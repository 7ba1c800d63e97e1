"""Crop, regrid, zonal reduction, the whole reduction and the incremental ingest."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basinspark.functions.hydro import cell_area
from basinspark.operators import grid
from basinspark.plans.reduction import run_table_from_grid
from basinspark.schemas import GRID_TABLE, MASK_TABLE
from basinspark.streaming.ingest import ingest_runs, stored_means

QUIET = [HealthCheck.function_scoped_fixture, HealthCheck.too_slow]


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def field(spark, function, n_lat=4, n_lon=5, skip=()):
    cells = [(1, i, j, float(function(i, j))) for i in range(n_lat) for j in range(n_lon) if (i, j) not in skip]
    return spark.createDataFrame(cells, "run int, lat_i int, lon_i int, value double")


def points(spark, *places):
    return spark.createDataFrame(
        [(n, 0, float(lat), float(lon)) for n, (lat, lon) in enumerate(places)], "lat_i int, lon_i int, lat double, lon double"
    )


@settings(max_examples=4, deadline=None, suppress_health_check=QUIET)
@given(st.floats(-3, 3), st.floats(-3, 3), st.floats(-3, 3))
def test_regrid_is_exact_on_linear_fields(spark, a, b, c):
    places = [(50.0, 0.0), (49.3, 3.7), (47.0, 4.0), (48.5, 1.25)]
    weights = grid.bilinear_weights(points(spark, *places), 50.0, -1.0, 4, 0.0, 1.0, 5)
    found = dict((r.lat_i, r.value) for r in grid.regrid(field(spark, lambda i, j: a + b * i + c * j), weights, ["run"]).collect())
    assert len(found) == 4
    for n, (lat, lon) in enumerate(places):
        assert found[n] == pytest.approx(a + b * (50 - lat) + c * lon, abs=1e-9)


def test_regrid_outside_and_missing_neighbours(spark):
    places = [(0.5, 0.5), (1.0, 1.0), (1.5, 1.5), (3.1, 0.0), (0.0, -0.1), (2.0, 2.5)]
    weights = grid.bilinear_weights(points(spark, *places), 0.0, 1.0, 4, 0.0, 1.0, 5)
    assert {r.lat_i for r in weights.collect()} == {0, 1, 2, 5}
    found = grid.regrid(field(spark, lambda i, j: i + j, skip={(2, 2)}), weights, ["run"])
    assert {r.lat_i: r.value for r in found.collect()} == {0: 1.0, 1: 2.0, 2: None, 5: None}


def test_crop_is_inclusive_and_padded(spark):
    cells = spark.createDataFrame([(float(i), float(j)) for i in range(10) for j in range(10)], "lat double, lon double")
    mask = spark.createDataFrame([(3.0, 4.0), (5.0, 4.0)], "lat double, lon double")
    assert grid.crop(cells, mask).count() == 3
    assert grid.crop(cells, mask, pad_lat=1.0, pad_lon=1.0).count() == 15


@pytest.fixture(scope="module")
def mask(spark):
    return spark.createDataFrame(
        [(0, 0, "eri_lake", 1.0), (1, 0, "eri_lake", 0.25), (2, 0, "eri_lake", None), (3, 0, "eri_lake", 0.0), (1, 0, "sup_land", 1.0)],
        MASK_TABLE,
    )


def test_zonal_means_by_hand(spark, mask):
    cells = spark.createDataFrame(
        [(0, 0, 2.0), (1, 0, 6.0), (2, 0, 100.0), (3, 0, 100.0)], "lat_i int, lon_i int, value double"
    )
    zoned = grid.in_zone(cells, grid.prepare_mask(mask))
    area = F.when(F.col("lat_i") == 0, 1.0).otherwise(4.0)
    weighted = grid.zonal_mean(zoned, ["zone"], area=area, factor=10.0)
    assert rows(weighted) == [("eri_lake", (2 * 1 * 1 + 6 * 0.25 * 4) * 10 / 2), ("sup_land", 60.0)]
    assert rows(grid.zonal_plain_mean(zoned, ["zone"])) == [("eri_lake", 4.0), ("sup_land", 6.0)]


def test_missing_cells_count_in_neither_sum(spark, mask):
    cells = spark.createDataFrame([(0, 0, 2.0), (1, 0, None)], "lat_i int, lon_i int, value double")
    zoned = grid.in_zone(cells, grid.prepare_mask(mask))
    assert rows(grid.zonal_mean(zoned, ["zone"], area=F.lit(3.0))) == [("eri_lake", 2.0), ("sup_land", None)]
    assert rows(grid.zonal_plain_mean(zoned, ["zone"])) == [("eri_lake", 2.0), ("sup_land", None)]


@settings(max_examples=4, deadline=None, suppress_health_check=QUIET)
@given(st.floats(0.1, 9), st.lists(st.floats(0.1, 1), min_size=1, max_size=5))
def test_mean_of_a_constant_is_the_constant(spark, constant, weights):
    cells = spark.createDataFrame(
        [(constant, w, 40.0 + n) for n, w in enumerate(weights)], "value double, weight double, lat double"
    ).withColumn("zone", F.lit("z"))
    found = grid.zonal_mean(cells, ["zone"], area=cell_area("lat", 0.5, 0.5), factor=4.0 * 30).first()
    assert found.value == pytest.approx(constant * 120, rel=1e-12)


def test_month_factor(spark):
    df = spark.createDataFrame([("precipitation",), ("evaporation",), ("air_temperature",)], "c string")
    found = dict(df.select("c", grid.month_factor("c", F.lit(2025), F.lit(6))).collect())
    assert found == {"precipitation": 120.0, "evaporation": 30 * 86400.0, "air_temperature": 1.0}


def test_unknown_zone_prefix_is_an_error(spark):
    with pytest.raises(Exception, match="No entry for abc"):
        grid.zone_fields(spark.createDataFrame([("abc_lake",)], "zone string")).collect()


def grid_rows(run, variable, value, cells=3):
    level = ("heightAboveGround", 2) if variable.endswith("2t") else ("surface", 0)
    return [(run, 2025, 6, variable, *level, i, j, 40.0 + i, -90.0 + j, value) for i in range(cells) for j in range(cells)]


def test_reduction_takes_each_variable_from_its_level(spark):
    from basinspark.plans.reduction import reduction_fields

    fields = spark.createDataFrame(
        [("tp", "surface", 0), ("tp", "isobaricInhPa", 850), ("avg_2t", "heightAboveGround", 2), ("avg_2t", "heightAboveGround", 10), ("mean2t", "surface", 0)],
        "variable string, level_type string, level int",
    )
    assert rows(reduction_fields(fields)) == [("avg_2t", "heightAboveGround", 2), ("tp", "surface", 0)]


def test_repeated_cells_and_missing_neighbours(spark):
    points = spark.createDataFrame([(0, 0, 0.5, 0.5)], "lat_i int, lon_i int, lat double, lon double")
    weights = grid.bilinear_weights(points, 0.0, 1.0, 2, 0.0, 1.0, 2)
    cells = [("a", 0, 0, 1.0), ("a", 0, 1, 2.0), ("a", 1, 0, 3.0), ("a", 1, 1, 4.0)]
    once = [(f"{k}", *c[1:]) for k in "a" for c in cells]
    twice = [("b", *c[1:]) for c in cells * 2]
    hole = [("c", *c[1:]) for c in [*cells[:3], cells[0]]] + [("c", 1, 1, float("nan"))]
    df = spark.createDataFrame(once + twice + hole, "k string, lat_i int, lon_i int, value double")
    assert {r.k: r.value for r in grid.regrid(df, weights, ["k"]).collect()} == {"a": 2.5, "b": 2.5, "c": None}


def test_whole_reduction_by_hand(spark):
    fields = spark.createDataFrame(
        grid_rows(1, "tp", 2.0) + grid_rows(1, "avg_2t", 273.15) + grid_rows(1, "mean2t", 1.0)
        + grid_rows(1, "mslhf", 100.0) + grid_rows(1, "unused", 5.0) + grid_rows(2, "mean2t", 280.0),
        GRID_TABLE,
    )
    cells = spark.createDataFrame(
        [(i, j, 40.25 + i, -89.75 + j) for i in range(2) for j in range(2)], "lat_i int, lon_i int, lat double, lon double"
    )
    weights = grid.bilinear_weights(cells, 40.0, 1.0, 3, -90.0, 1.0, 3)
    mask = cells.select("lat_i", "lon_i", "lat", F.lit("mih_land").alias("zone"), (F.col("lat_i") + 0.5).alias("weight"))
    table = run_table_from_grid(fields, weights, mask, 1.0, 1.0)
    found = {(r.cfs_run, r.component): r["value [mm]"] for r in table.collect()}
    assert set(found) == {(1, "precipitation"), (1, "air_temperature"), (1, "evaporation"), (2, "air_temperature")}
    assert found[1, "precipitation"] == pytest.approx(240.0)
    assert found[1, "air_temperature"] == pytest.approx(273.15)
    assert found[1, "evaporation"] == pytest.approx(100e-6 / 2.501 * 30 * 86400)
    assert found[2, "air_temperature"] == pytest.approx(280.0)
    first = table.where("component = 'precipitation'").first()
    assert (first.lake, first.surface_type) == ("michigan-huron", "land")
    missing = grid.expected_combinations(table, ["precipitation", "air_temperature"], [("michigan-huron", "land")])
    assert rows(missing) == [(2, 2025, 6, "michigan-huron", "land", "precipitation")]


def test_ingest_in_parts_equals_one_batch(spark, tmp_path, mask):
    schema = "run long, year int, month int, variable string, lat_i int, lon_i int, value double"
    source = np.random.default_rng(7)
    data = [(r, 2025, m, "tp", i, 0, float(source.random())) for r in (1, 2) for m in (5, 6) for i in (0, 1)]
    keys = ["run", "year", "month", "variable", "zone"]
    arrivals, target = str(tmp_path / "in"), str(tmp_path / "sums")

    def arrive(part):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(arrivals)

    def ingest(progress, after_run=None):
        ingest_runs(
            spark, arrivals, spark.createDataFrame([], schema).schema, mask, target, str(tmp_path / progress),
            area=F.lit(2.0), files_per_batch=1, after_run=after_run,
        )

    # The cells of each run and month are split between files.
    arrive(data[0::2])
    ingest("a")
    arrive(data[1::2])
    ingest("a")
    ingest("b")
    zoned = grid.in_zone(spark.createDataFrame(data, schema), grid.prepare_mask(mask))
    for weighted, expected in (
        (True, grid.zonal_mean(zoned, keys, area=F.lit(2.0), factor=3.0)),
        (False, grid.zonal_plain_mean(zoned, keys)),
    ):
        found = stored_means(spark.read.parquet(target), keys, 3.0 if weighted else 1.0, weighted)
        a, b = rows(found), rows(expected)
        assert [r[:5] for r in a] == [r[:5] for r in b] and len(a) == 8
        assert all(math.isclose(x[5], y[5], rel_tol=1e-12) for x, y in zip(a, b, strict=True))
    target = str(tmp_path / "later")
    ingest("c", after_run=1)
    assert {r.run for r in spark.read.parquet(target).collect()} == {2}


@pytest.mark.parametrize("whole", [True, False])
def test_many_targets_per_cell_are_dealt_over_tasks(spark, monkeypatch, whole):
    """A few cells with many targets, with the field sent to all tasks or dealt, against the broadcast of the weights."""
    places = spark.range(400).selectExpr("id AS target", "(id % 61) / 20 AS lat", "(id % 37) / 10 AS lon")
    weights = grid.bilinear_weights(places, 0.0, 1.0, 4, 0.0, 1.0, 5, target=["target"])
    cells = field(spark, lambda i, j: 10 * i + j * j, skip={(2, 2)}).withColumn("run", F.explode(F.array(F.lit(1), F.lit(2))))
    cells = cells.unionByName(cells.withColumn("value", F.col("value") + F.lit(4.0)))
    monkeypatch.setattr(grid, "MOST_TARGETS", 10_000)
    expected = rows(grid.regrid(cells, weights, ["run"], target=["target"]))
    monkeypatch.setattr(grid, "MOST_TARGETS", 64)
    monkeypatch.setattr(grid, "TASK_PAIRS", 100)
    if not whole:
        monkeypatch.setattr(grid, "broadcast_if_small", lambda side: side)
    found = grid.regrid(cells, weights, ["run"], target=["target"])
    sizes = [len(part) for part in found.rdd.glom().collect()]
    found = rows(found)
    assert [r[:2] for r in found] == [r[:2] for r in expected] and len(found) > 700
    assert [r[2] is None for r in found] == [r[2] is None for r in expected]
    assert [r[2] or 0.0 for r in found] == pytest.approx([r[2] or 0.0 for r in expected], rel=1e-12)
    assert not whole or max(sizes) < len(found) / 8
