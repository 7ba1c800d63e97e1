"""Column expressions against hand-computed values."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basinspark.functions import calendar, hydro, names
from basinspark.functions.numbers import mean, rounded
from basinspark.schemas import COMPONENT_NAMES, FEATURES, LAKE_AREAS, LAKE_NAMES, MASK_LAKE_AREAS, TARGETS


def value(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("year", "month", "seconds"), [(2024, 2, 2505600), (2025, 2, 2419200), (2025, 1, 2678400), (2025, 4, 2592000)]
)
def test_seconds_in_month(spark, year, month, seconds):
    assert value(spark, calendar.seconds_in_month(F.lit(year), F.lit(month))) == seconds


@pytest.mark.parametrize("month", [0, 13])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_month_out_of_range_is_an_error(spark, month, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="between 1 and 12"):
            value(spark, calendar.seconds_in_month(F.lit(2025), F.lit(month)))
        assert value(spark, calendar.seconds_in_month(F.lit(2025), F.lit(None).cast("int"))) is None
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize(
    ("run", "label"),
    [
        (2025051818, "05-19-2025 00"),
        (2025051806, "05-18-2025 12"),
        (2025051812, "05-18-2025 18"),
        (2025051800, "05-18-2025 06"),
        (2025051803, "05-18-2025 06"),
        (2024123118, "01-01-2025 00"),
    ],
)
def test_next_run(spark, run, label):
    assert value(spark, calendar.next_run(F.lit(run))) == label
    assert value(spark, calendar.next_run(F.lit(str(run)))) == label


def test_run_calendar_bounds(spark):
    spans = spark.createDataFrame(
        [("a", "05-01-2025", "05-02-2025"), ("b", "05-01-2025 12", "05-01-2025 12"), ("c", "05-02-2025", "05-01-2025")],
        "name string, first string, last string",
    ).select("name", calendar.run_boundary("first", 0).alias("a"), calendar.run_boundary("last", 18).alias("b"))
    runs = calendar.run_calendar(spans, "a", "b").select("name", calendar.run_id("run_ts").alias("run")).collect()
    assert [r.run for r in runs if r.name == "a"] == [
        2025050100, 2025050106, 2025050112, 2025050118, 2025050200, 2025050206, 2025050212, 2025050218,
    ]
    assert [r.run for r in runs if r.name == "b"] == [2025050112]
    assert not [r for r in runs if r.name == "c"]


def test_missing_runs(spark):
    stored = spark.createDataFrame([(2025051806,), (2025051812,)], "run long")
    found = calendar.missing_runs(stored, "run", dt.date(2025, 5, 20)).collect()
    assert [r.run for r in found] == [2025051818, 2025051900, 2025051906, 2025051912, 2025051918]
    assert calendar.missing_runs(stored, "run", dt.date(2025, 5, 18)).count() == 0
    assert calendar.missing_runs(stored.limit(0), "run", dt.date(2025, 5, 20)).count() == 0


def test_run_round_trip_and_path(spark):
    moment = calendar.run_moment(F.lit(2025051806))
    assert value(spark, moment) == dt.datetime(2025, 5, 18, 6)
    assert value(spark, calendar.run_id(moment)) == 2025051806
    assert value(spark, calendar.run_path(moment, "run.", "/monthly/")) == "run.20250518/06/monthly/"


def test_labels_and_names(spark):
    assert value(spark, calendar.month_label(F.lit(1950.0), F.lit(1.0))) == "1950-01"
    assert value(spark, calendar.month_label(F.lit(2025), F.lit(11), "_")) == "2025_11"
    assert value(spark, calendar.month_label(F.lit(2025), F.lit(None).cast("int"))) is None
    assert value(spark, calendar.next_run(F.lit(None).cast("long"))) is None
    assert value(spark, calendar.parse_month_name(F.lit(1900), F.lit(" Dec "))) == dt.date(1900, 12, 1)
    assert value(spark, calendar.valid_month(F.lit(dt.date(2024, 11, 1)), calendar.lead_offset(F.lit("four")))) == dt.date(
        2025, 2, 1
    )
    assert value(spark, calendar.lead_offset(F.lit("seven"))) is None


def test_month_one_hot_has_all_months(spark):
    df = calendar.month_one_hot(spark.createDataFrame([(3,), (3,)], "month int"), "month")
    assert df.columns == ["month", *[f"month_{m}" for m in range(1, 13)]]
    assert [row["month_3"] for row in df.collect()] == [1, 1]
    assert sum(df.first()[1:]) == 1


def test_published_conversion(spark):
    assert value(
        spark, hydro.mm_to_cms(F.lit(28.681), F.lit("superior"), F.lit(2026), F.lit(2), LAKE_AREAS)
    ) == pytest.approx(973.32, abs=0.02)
    assert value(
        spark, hydro.mm_to_cms(F.lit(98.315), F.lit("erie"), F.lit(2025), F.lit(5), LAKE_AREAS)
    ) == pytest.approx(941.709, abs=0.01)


def test_unknown_lake(spark):
    arguments = (F.lit(5.0), F.lit("st clair"), F.lit(2025), F.lit(5), LAKE_AREAS)
    assert value(spark, hydro.mm_to_cms(*arguments)) == 0
    assert value(spark, hydro.cms_to_mm(*arguments)) == 5


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.floats(-1e4, 1e4), st.sampled_from(sorted(MASK_LAKE_AREAS)), st.integers(1900, 2100), st.integers(1, 12)
)
def test_conversions_are_inverse(spark, amount, lake, year, month):
    place = (F.lit(lake), F.lit(year), F.lit(month), MASK_LAKE_AREAS)
    back = value(spark, hydro.cms_to_mm(hydro.mm_to_cms(F.lit(amount), *place), *place))
    assert back == pytest.approx(amount, rel=1e-12, abs=1e-12)


def test_evaporation_rate(spark):
    assert value(spark, hydro.evaporation_rate(F.lit(273.15), F.lit(100.0))) == pytest.approx(3.998401e-5, rel=1e-6)


def test_cell_area(spark):
    by_hand = 6371000.0**2 * (3.141592653589793 / 720) ** 2 * 0.7071067811865476
    for step in (0.25, -0.25):
        assert value(spark, hydro.cell_area(F.lit(45.0), step, 0.25)) == pytest.approx(by_hand, rel=1e-12)


def test_recoding(spark):
    assert value(spark, names.recoded(F.lit("mih"), LAKE_NAMES)) == "michigan-huron"
    assert value(spark, names.recoded(F.lit("tmp"), COMPONENT_NAMES, "keep")) == "air_temperature"
    assert value(spark, names.recoded(F.lit("other"), COMPONENT_NAMES, "keep")) == "other"
    with pytest.raises(Exception, match="No entry for other"):
        value(spark, names.recoded(F.lit("other"), LAKE_NAMES))


def test_composite_names(spark):
    assert value(spark, names.composite(F.lit("erie"), F.lit("lake"), F.lit("cnbs"))) == "erie_lake_cnbs"
    assert value(spark, names.composite(F.lit("erie"), F.lit(None).cast("string"))) is None
    assert value(spark, names.name_part(F.lit("michigan-huron_cnbs"), "_", 0)) == "michigan-huron"
    assert value(spark, names.name_part(F.lit("a.b"), ".", 1)) == "b"
    assert value(spark, names.name_part(F.lit("a.b"), ".", 2)) is None


def test_numbers(spark):
    df = spark.createDataFrame([(1.0,), (None,), (4.0,)], "v double")
    assert df.select(mean("v")).first()[0] == 2.5
    assert df.where("v > 9").select(mean("v")).first()[0] is None
    assert value(spark, rounded(F.lit(0.0625), 3)) == 0.062
    assert value(spark, rounded(F.lit(0.1875), 3)) == 0.188


def test_fixed_lists():
    assert len(FEATURES) == 36 and len(TARGETS) == 16
    assert FEATURES[:2] == ["superior_lake_precipitation", "erie_lake_precipitation"]
    assert FEATURES[23] == "michigan-huron_land_air_temperature" and FEATURES[24] == "month_1"
    assert TARGETS[0] == "superior_evaporation" and TARGETS[-1] == "michigan-huron_cnbs"
