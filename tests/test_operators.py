"""Joins, reshaping, checks, ensemble statistics, quantiles and shifts."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basinspark.operators import ensemble, joins, records, shape
from basinspark.operators.groups import split_groups
from basinspark.operators.positions import with_position
from basinspark.operators.quantiles import exact_quantiles
from basinspark.operators.windows import lag_lead, lag_lead_by_month


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


QUIET = [HealthCheck.function_scoped_fixture, HealthCheck.too_slow]


# Hot groups: one key holds most rows.


@pytest.fixture(scope="module")
def skewed():
    source = np.random.default_rng(3)
    keys = np.where(source.random(4000) < 0.6, "hot", source.choice(["a", "b", "c", "d"], 4000))
    values = np.round(source.normal(0, 5, 4000), 1)
    values[source.random(4000) < 0.05] = np.nan
    return pd.DataFrame({"key": keys, "value": values, "other": source.integers(0, 9, 4000).astype(float)})


@pytest.mark.parametrize("small_group", [100_000, 700, 0])
def test_quantiles_equal_pandas_for_any_split(spark, skewed, small_group):
    probabilities = {"lower": 0.025, "middle": 0.5, "upper": 0.975, "top": 1.0}
    df = spark.createDataFrame(skewed).repartition(5)
    found = exact_quantiles(df, ["key"], ["value", "other"], probabilities, small_group).toPandas().set_index("key")
    grouped = skewed.groupby("key")
    for column in ("value", "other"):
        for label, p in probabilities.items():
            expected = grouped[column].quantile(p)
            assert np.allclose(found[f"{column}_{label}"].loc[expected.index], expected, rtol=1e-14, atol=0)


def test_quantiles_of_one_row_null_keys_and_missing_columns(spark):
    df = spark.createDataFrame(
        [("a", 3.0, None), (None, 9.0, 1.0), ("b", None, 2.0)], "key string, `v [mm]` double, w double"
    )
    for small_group in (100, 0):
        found = exact_quantiles(df, ["key"], ["v [mm]", "w"], {"q": 0.3}, small_group)
        assert rows(found) == [("a", 3.0, None), ("b", None, 2.0)]


def test_median_keeps_names(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 4.0), ("a", 8.0)], "key string, `v [mm]` double")
    assert rows(ensemble.ensemble_median(df, ["key"], ["v [mm]"], digits=3)) == [("a", 3.0)]


def test_split_groups(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2, "key string")
    small, large, keys = split_groups(df, ["key"], 3)
    assert rows(small) == [("b",)] * 2 and rows(large) == [("a",)] * 5 and rows(keys) == [("a",)]
    assert split_groups(df, ["key"], 5) == (df, None, None)
    assert split_groups(df, [], 6)[0] is None and split_groups(df, [], 7)[1] is None


@pytest.mark.parametrize("small_group", [2, 100_000])
def test_group_without_values_keeps_its_row(spark, small_group):
    df = spark.createDataFrame([("a", None)] * 5 + [("b", 1.0)] * 5, "key string, v double")
    assert rows(exact_quantiles(df, ["key"], ["v"], {"half": 0.5}, small_group)) == [("a", None), ("b", 1.0)]


def test_horizon_that_is_too_short_is_an_error(spark):
    df = spark.createDataFrame([("x", 2000, m, 1.0) for m in range(1, 6)], "lake string, year int, month int, v double")
    with pytest.raises(ValueError, match="5 months"):
        ensemble.lead_table(df, ["lake"], "year", "month", "v", horizon=3)
    assert len(ensemble.lead_table(df, ["lake"], "year", "month", "v", horizon=7).columns) == 8


def test_mean_leaves_out_nan(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("b", float("nan"))], "key string, v double")
    assert rows(ensemble.ensemble_mean(df, ["key"], ["v"])) == [("a", 1.0), ("b", None)]


def test_positions_follow_the_order(spark):
    numbers = list(np.random.default_rng(1).permutation(3000))
    df = spark.createDataFrame([(int(n), -int(n)) for n in numbers], "n int, m int").repartition(7)
    placed = with_position(df, ["n"]).toPandas().sort_values("n")
    assert (placed["position"].to_numpy() == np.arange(3000)).all()


@pytest.mark.parametrize("small_group", [100_000, 300, 7])
def test_lag_lead_equals_pandas_for_any_chunk(spark, small_group):
    source = np.random.default_rng(5)
    frame = pd.DataFrame({"series": np.where(source.random(1200) < 0.7, "hot", "cold"), "at": source.permutation(1200)})
    frame["v"] = source.normal(size=1200)
    found = lag_lead(spark.createDataFrame(frame), ["series"], ["at"], ["v"], lag=9, lead=2, small_group=small_group)
    ordered = frame.sort_values("at")
    for k in range(1, 10):
        ordered[f"v_mo-{k}"] = ordered.groupby("series")["v"].shift(k)
    for k in range(1, 3):
        ordered[f"v_mo{k}"] = ordered.groupby("series")["v"].shift(-k)
    expected = ordered.dropna().sort_values("at").reset_index(drop=True)
    pd.testing.assert_frame_equal(found.toPandas().sort_values("at").reset_index(drop=True)[expected.columns], expected)


def test_lag_lead_defaults_drop_incomplete_rows(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan"))], "at int, v double")
    assert rows(lag_lead(df, [], ["at"], ["v"])) == [(1, 1.0)]
    assert rows(lag_lead(df.where("at < 3"), [], ["at"], ["at"], lag=1)) == []


def test_calendar_shift_respects_gaps(spark):
    months = [dt.date(2025, 1, 1), dt.date(2025, 2, 1), dt.date(2025, 4, 1), dt.date(2025, 5, 1)]
    df = spark.createDataFrame([("s", m, float(i)) for i, m in enumerate(months)], "s string, m date, v double")
    found = lag_lead_by_month(df, ["s"], "m", ["v"], lag=1)
    assert rows(found) == [("s", dt.date(2025, 2, 1), 1.0, 0.0), ("s", dt.date(2025, 5, 1), 3.0, 2.0)]


# Reshaping.


def test_pivot_averages_duplicates_and_keeps_all_columns(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "a", 3.0), (2, "b", 5.0)], "i int, name string, v double")
    assert rows(shape.to_wide(df, ["i"], "name", ["a", "b", "c"], "v")) == [(1, 2.0, None, None), (2, None, 5.0, None)]
    assert rows(shape.to_wide(df, ["i"], "name", ["a", "c"], "v", fill=0.0)) == [(1, 2.0, 0.0)]


@settings(max_examples=5, deadline=None, suppress_health_check=QUIET)
@given(st.lists(st.tuples(st.floats(-9, 9), st.floats(-9, 9)), min_size=1, max_size=6))
def test_unpivot_then_pivot_is_identity(spark, pairs):
    df = spark.createDataFrame([(i, a + 0.0, b + 0.0) for i, (a, b) in enumerate(pairs)], "i int, a_x double, `b-c_x` double")
    long = shape.to_long(df, ["i"], ["a_x", "b-c_x"], "name", "v")
    assert rows(shape.to_wide(long, ["i"], "name", ["a_x", "b-c_x"], "v")) == rows(df)


def test_wide_file_to_records(spark):
    df = spark.createDataFrame([(1, 2025, 5, 1.0, 2.0)], "run int, year int, month int, sup_pcp_lake double, xyz_abc_land double")
    found = shape.wide_to_records(
        df, ["run", "year", "month"], ["lake", "component", "surface_type"], "value",
        {"lake": {"sup": "superior"}, "component": {"pcp": "precipitation"}},
    )
    assert rows(found) == [
        (1, 2025, 5, "superior", "precipitation", "lake", 1.0),
        (1, 2025, 5, "xyz", "abc", "land", 2.0),
    ]


def test_recode_by_table(spark):
    df = spark.createDataFrame([("a", 1), ("z", 2)], "code string, v int")
    lookup = spark.createDataFrame([("a", "alpha")], "code string, name string")
    assert rows(shape.recode(df, "code", lookup, "keep")) == [("alpha", 1), ("z", 2)]
    with pytest.raises(Exception, match="No entry for z"):
        shape.recode(df, "code", lookup).collect()


def test_basin_arithmetic(spark):
    df = spark.createDataFrame([(1, 10.0, 20.0, 6.0)], "run int, WaterMichigan double, WaterHuron double, WaterErie double")
    spec = {
        "mih": ("total", ["WaterMichigan", "WaterHuron"], 5),
        "mih_t": ("mean", ["WaterMichigan", "WaterHuron"]),
        "eri": ("total", ["WaterErie"], 3),
    }
    assert rows(shape.merge_basins(df, ["run"], spec)) == [(1, 6.0, 15.0, 2.0)]
    with pytest.raises(ValueError):
        shape.merge_basins(df, ["run"], {"x": ("other", ["WaterErie"])})


def test_closure_gap(spark):
    df = spark.createDataFrame(
        [("e", "precipitation", 5.0), ("e", "evaporation", 2.0), ("e", "runoff", 1.0), ("e", "cnbs", 7.0), ("s", "cnbs", 1.0)],
        "lake string, component string, v double",
    )
    assert rows(shape.closure_gap(df, ["lake"], "component", "v")) == [("e", 7.0, 4.0, 3.0), ("s", 1.0, None, None)]


def test_column_selection(spark):
    df = spark.createDataFrame([], "erie_lake_evaporation double, erie_evaporation_obs double, ontario_lake_evaporation double")
    assert shape.columns_like(df, suffix="_lake_evaporation") == ["erie_lake_evaporation", "ontario_lake_evaporation"]
    assert shape.paired_columns(df, "_lake_evaporation", "_evaporation_obs") == {"erie_lake_evaporation": "erie_evaporation_obs"}
    assert shape.ensure_columns(df, ["month_1"]).columns[-1] == "month_1"


# Record checks.


def test_record_checks(spark):
    good = (2025051800, 2025, 5, "erie", "lake", "precipitation", 1.0)
    bad_month, no_lake, no_value = list(good), list(good), list(good)
    bad_month[2], no_lake[3], no_value[6] = 13, None, None
    df = spark.createDataFrame(
        [good, tuple(bad_month), tuple(no_lake), tuple(no_value)],
        "cfs_run long, year int, month int, lake string, surface_type string, component string, `value [mm]` double",
    )
    accepted, rejected = records.split_valid(df, records.run_record_rules())
    assert rows(accepted) == [good]
    assert sorted(r.reason for r in rejected.collect()) == ["key missing", "month outside 1-12", "value missing"]
    assert records.validated(df.limit(1), records.run_record_rules()).count() == 1
    with pytest.raises(Exception, match="month outside 1-12"):
        records.validated(df.where("month = 13"), records.run_record_rules()).collect()


def test_missing_values(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, None), (-99990.0, "c")], "v double, `n m` string")
    assert dict(rows(records.null_report(df))) == {"v": 2, "n m": 1}
    assert records.incomplete_rows(df).count() == 2 and records.drop_incomplete(df).count() == 2
    assert records.null_sentinel(df.where("v < 0"), ["v"], -99990.0).first()["v"] is None
    assert records.null_sentinel(df.where("v < 0"), ["v"], -99990.0, drop=True).count() == 0


# Ensembles.


@pytest.mark.parametrize(
    ("as_of", "kept"),
    [
        (dt.date(2025, 5, 25), [(2025, 5), (2025, 6), (2025, 12), (2026, 1)]),
        (dt.date(2025, 5, 26), [(2025, 6), (2025, 12), (2026, 1)]),
        (dt.date(2025, 12, 25), [(2025, 12), (2026, 1)]),
        (dt.date(2025, 12, 26), [(2026, 1)]),
    ],
)
def test_forecast_cutoff(spark, as_of, kept):
    df = spark.createDataFrame([(2024, 11), (2025, 4), (2025, 5), (2025, 6), (2025, 12), (2026, 1)], "year int, month int")
    assert rows(ensemble.forecast_cutoff(df, as_of)) == sorted(kept, key=repr)


def test_means_tags_and_leads(spark):
    df = spark.createDataFrame(
        [(2025, 12, "e", 1.0), (2025, 12, "e", 2.0), (2026, 1, "e", 4.0), (2026, 1, "s", None), (None, 1, "e", 9.0)],
        "year int, month int, lake string, `v [mm]` double",
    )
    means = ensemble.ensemble_mean(df, ["year", "month", "lake"], ["v [mm]"], digits=3)
    assert rows(means) == [(2025, 12, "e", 1.5), (2026, 1, "e", 4.0), (2026, 1, "s", None)]
    tagged = ensemble.tag_first_period(means, "year", "month").select("current_year", "current_month").distinct()
    assert rows(tagged) == [(2025, 12)]
    for horizon in (None, 2):
        leads = ensemble.lead_table(means, ["lake"], "year", "month", "v [mm]", horizon)
        assert leads.columns == ["lake", "month_1", "month_2"] and rows(leads) == [("e", 1.5, 4.0)]
    assert ensemble.numeric_means(df, ["lake"], exclude=["year"]).columns == ["lake", "month", "v [mm]"]
    low, high = ensemble.padded_range(df, F.lit("all"), "`v [mm]`").select("range_low", "range_high").first()
    assert (low, high) == (-9.0, 19.0)


def test_first_leads_and_union(spark):
    df = spark.createDataFrame([(s, i) for s in "ab" for i in range(12)], "s string, i int")
    assert rows(ensemble.first_leads(df, ["s"], ["i"]).groupBy("s").agg(F.max("i"))) == [("a", 7), ("b", 7)]
    stacked = ensemble.union_models({"GP": df, "RF": df.select("i", "s")})
    assert rows(stacked.groupBy("model").count()) == [("GP", 24), ("RF", 24)]


# Joins.


def months(spark, name, *pairs):
    return spark.createDataFrame([(2025, m, v) for m, v in pairs], f"year int, month int, {name} double")


def test_observation_joins(spark):
    a, b = months(spark, "v", (1, 1.0), (2, 2.0)), months(spark, "v", (2, 3.0), (3, 4.0))
    outer = joins.outer_series({"a": a, "b": b}, ["year", "month"], "v", "_obs")
    assert rows(outer) == [(2025, 1, 1.0, None), (2025, 2, 2.0, 3.0), (2025, 3, None, 4.0)]
    left = joins.attach_observed(a, [b.withColumnRenamed("v", "o")], ["year", "month"])
    assert rows(left) == [(2025, 1, 1.0, None), (2025, 2, 2.0, 3.0)]
    assert joins.attach_observed(a, [b.withColumnRenamed("v", "o")], ["year", "month"], complete=True).count() == 1
    aligned = joins.aligned_columns({"a": (a, "v"), "b": (b, "v")}, ["year", "month"])
    assert rows(aligned) == [(2025, 2, 2.0, 3.0)]


def test_strict_alignment(spark):
    a, b = months(spark, "v", (1, 1.0), (2, 2.0)), months(spark, "t", (2, 3.0), (3, 4.0))
    assert rows(joins.unmatched(a, b, ["year", "month"])) == [(2025, 1)]
    assert rows(joins.strict_align(a.where("month = 2"), b, ["year", "month"])) == [(2025, 2, 2.0, 3.0)]
    with pytest.raises(Exception, match="No target for 2025 1"):
        joins.strict_align(a, b, ["year", "month"]).collect()


def test_row_comparison_up_to_the_shortest_file(spark):
    def file(*values):
        return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "line int, v string")

    found = joins.compare_rows({"a": file("x", "y", "z", "w"), "b": file("x", "q", "z"), "c": file("x", "y", None)}, ["line"], ["v"])
    assert rows(found) == [(2, "a / b"), (2, "b / c"), (3, "a / c"), (3, "b / c")]


def test_keyed_comparison(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(2, None), (3, "q"), (4, "w")], "k int, v string")
    assert rows(joins.compare_keyed(a, b, ["k"], ["v"])) == [(1, "only in first"), (3, "differs"), (4, "only in second")]
