"""Skill scores against direct numpy computations, CRPS against the pairwise form, formats and feeds."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basinspark.operators import skill
from basinspark.schemas import MONTH_NAMES

QUIET = [HealthCheck.function_scoped_fixture, HealthCheck.too_slow]


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def by_numpy(p, o, scaling):
    def standard(x, like):
        spread = like.std()
        return (x - like.mean()) / (spread if spread > 0 else 1.0)

    zp, zo = standard(p, p if scaling == "own" else o), standard(o, o)
    error = ((zo - zp) ** 2).mean()
    total = ((zo - zo.mean()) ** 2).mean()
    r2 = 1 - error / total if total > 0 else float(error == 0)
    a, b = (p, o) if scaling == "obs_raw" else (zp, zo)
    return [np.sqrt(error), r2, (a - b).mean(), a.var(), np.abs(a - b).mean()]


@pytest.fixture(scope="module")
def frame():
    source = np.random.default_rng(11)
    df = pd.DataFrame({"model": source.choice(["GP", "RF"], 400, p=[0.8, 0.2]), "obs": source.normal(50, 20, 400)})
    df["pred"] = df.obs * 0.7 + source.normal(5, 9, 400)
    df.loc[source.random(400) < 0.1, "obs"] = np.nan
    df.loc[source.random(400) < 0.1, "pred"] = np.nan
    return df


@pytest.mark.parametrize("scaling", ["obs_raw", "obs_std", "own"])
@pytest.mark.parametrize("by", [["model"], []])
def test_scores_equal_numpy(spark, frame, scaling, by):
    found = skill.skill(spark.createDataFrame(frame), by, scaling=scaling)
    whole = frame.dropna()
    for row in found.collect():
        part = whole[whole.model == row.model] if by else whole
        assert row.n_pairs == len(part)
        expected = by_numpy(part.pred.to_numpy(), part.obs.to_numpy(), scaling)
        assert [row[name] for name in skill.SCORES] == pytest.approx(expected, rel=1e-9, abs=1e-12)
    assert found.count() == (2 if by else 1)


@pytest.mark.parametrize("scaling", ["obs_raw", "obs_std", "own"])
@pytest.mark.parametrize(("pred", "obs"), [([1.0, 3.0], [2.0, 2.0]), ([2.0, 2.0], [2.0, 2.0]), ([5.0], [4.0])])
def test_constant_observations(spark, scaling, pred, obs):
    df = spark.createDataFrame(list(zip(pred, obs, strict=True)), "pred double, obs double")
    row = skill.skill(df, scaling=scaling).first()
    expected = by_numpy(np.array(pred), np.array(obs), scaling)
    assert [row[name] for name in skill.SCORES] == pytest.approx(expected, abs=1e-12)


@settings(max_examples=4, deadline=None, suppress_health_check=QUIET)
@given(st.floats(0.1, 20), st.floats(-50, 50))
def test_determination_does_not_depend_on_units(spark, frame, scale, shift):
    df = spark.createDataFrame(frame.dropna())
    moved = df.select("model", (F.col("pred") * scale + shift).alias("pred"), (F.col("obs") * scale + shift).alias("obs"))
    assert skill.skill(moved).first().r2 == pytest.approx(skill.skill(df).first().r2, rel=1e-7)


def test_groups_need_complete_rows(spark):
    wide = spark.createDataFrame(
        [("GP", 1.0, 2.0, 3.0, 5.0), ("GP", 2.0, 2.0, None, 1.0), ("GP", 4.0, 9.0, 4.0, 4.0)],
        "model string, a double, a_obs double, b double, b_obs double",
    )
    pairs = {"a": ("a", "a_obs"), "b": ("b", "b_obs")}
    found = {r.group: r for r in skill.skill_groups(wide, pairs, {"All": ["a", "b"], "A's": ["a"]}).collect()}
    assert (found["All"].n_pairs, found["A's"].n_pairs) == (4, 3)
    expected = by_numpy(np.array([1.0, 3.0, 4.0, 4.0]), np.array([2.0, 5.0, 9.0, 4.0]), "obs_raw")
    assert [found["All"][name] for name in skill.SCORES] == pytest.approx(expected, abs=6e-4)


@pytest.mark.parametrize("small_group", [100_000, 20, 0])
def test_crps_equals_pairwise_form(spark, small_group):
    source = np.random.default_rng(2)
    frame = pd.DataFrame({"key": np.where(source.random(300) < 0.5, "hot", source.choice(list("abc"), 300))})
    frame["x"], frame["y"] = np.round(source.normal(0, 2, 300), 1), frame.key.map(len).astype(float)
    found = skill.crps(spark.createDataFrame(frame).repartition(5), ["key"], "x", "y", small_group=small_group)
    for row in found.collect():
        x = frame.x[frame.key == row.key].to_numpy()
        expected = np.abs(x - len(row.key)).mean() - np.abs(x[:, None] - x[None, :]).mean() / 2
        assert row.n_members == len(x) and row.crps == pytest.approx(expected, rel=1e-10)


def test_crps_of_one_member_is_the_absolute_error(spark):
    df = spark.createDataFrame([(1, 3.0, 5.0), (2, None, 1.0)], "k int, x double, y double")
    assert rows(skill.crps(df, ["k"], "x", "y")) == [(1, 1, 2.0)]


def test_formats(spark):
    wide = spark.createDataFrame([(1900, *[float(m) for m in range(11)], -99990.0)], ["Year", *MONTH_NAMES])
    observed = rows(skill.format_observed(wide))
    assert len(observed) == 11 and observed[0] == (dt.date(1900, 1, 1), 0.0)
    leads = spark.createDataFrame([(2024, 11, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0)], "year int, month int, one double, two double, three double, four double, five double, six double")
    found = rows(skill.format_leads(leads))
    assert found[2] == (dt.date(2024, 11, 1), dt.date(2025, 1, 1), 3.0) and len(found) == 6


def test_predictor_medians_and_plot_feed(spark):
    wide = spark.createDataFrame([(2025, 1, 1.0), (2025, 1, 5.0), (2025, 1, 6.0), (2025, 2, 4.0)], "year int, month int, p double")
    observed = spark.createDataFrame([(2025, 1, 9.0)], "year int, month int, o double")
    assert rows(skill.predictor_medians(wide, ["year", "month"], ["p"], observed)) == [(2025, 1, 5.0, 9.0)]
    rows_in = [("erie", m, 2025, k, v) for m, k, v in [("GP", 1, 1.0), ("GP", 1, 3.0), ("RF", 1, 5.0), ("RF", 2, 7.0), ("RF", 3, 8.0)]]
    df = spark.createDataFrame(rows_in, "series string, model string, year int, month int, v double")
    feed = rows(skill.plot_feed(df, "series", "model", "year", "month", "v", "2025-01-01", "2025-02-01"))
    assert [(r[1].month, r[2], r[3]) for r in feed] == [(1, "GP", 2.0), (1, "RF", 5.0), (2, "RF", 7.0)]
    assert feed[0][4:] == (pytest.approx(1.1), pytest.approx(4.9))
