"""From grid fields to the run table: one job for all runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basinspark.functions.hydro import cell_area, evaporation_rate
from basinspark.functions.numbers import null_if_nan
from basinspark.operators.grid import (
    in_zone,
    interpolated,
    month_factor,
    prepare_mask,
    weighted_neighbours,
    zonal_sums,
    zone_fields,
)

# Variable names of the fields, the preferred name first, and the level that each quantity is taken from.
PRECIPITATION = ["tp"]
TEMPERATURE = ["avg_2t", "mean2t"]
LATENT_HEAT = ["avg_slhtf", "mslhf"]
SURFACE = ("surface", None)
TWO_METRES = ("heightAboveGround", 2)

FIELD_KEYS = ["run", "year", "month"]


def reduction_fields(grid: DataFrame) -> DataFrame:
    """The fields that the reduction reads, each from its level if the table has levels."""
    if not {"level_type", "level"} <= set(grid.columns):
        return grid.where(F.col("variable").isin(*PRECIPITATION, *TEMPERATURE, *LATENT_HEAT))

    def at(names: list[str], level: tuple[str, int | None]):
        chosen = F.col("variable").isin(*names) & (F.col("level_type") == level[0])
        return chosen if level[1] is None else chosen & (F.col("level") == level[1])

    return grid.where(at(PRECIPITATION + LATENT_HEAT, SURFACE) | at(TEMPERATURE, TWO_METRES))


def component_cells(grid: DataFrame, weights: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Precipitation, air temperature and evaporation rate at every target cell, one row each: ``component, value``.

    All variables of a cell are interpolated in one grouping. Where a variable has two names, the preferred name counts
    if all its neighbours have a value.
    """
    near = weighted_neighbours(
        reduction_fields(grid), weights, [*keys, "variable", null_if_nan(F.col("value")).alias("_v")]
    )

    def first_of(names: list[str]):
        return F.coalesce(*[interpolated(F.when(F.col("variable") == name, F.col("_v"))) for name in names])

    cells = near.groupBy(*keys, F.col("_t0").alias("lat_i"), F.col("_t1").alias("lon_i")).agg(
        first_of(PRECIPITATION).alias("p"), first_of(TEMPERATURE).alias("t"), first_of(LATENT_HEAT).alias("le")
    )
    quantities = {"precipitation": F.col("p"), "air_temperature": F.col("t"), "evaporation": evaporation_rate("t", "le")}
    rows = F.array(*[F.struct(F.lit(name).alias("component"), q.alias("value")) for name, q in quantities.items()])
    return cells.select(*keys, "lat_i", "lon_i", F.inline(rows)).where("value IS NOT NULL")


def run_table_rows(sums: DataFrame) -> DataFrame:
    """Rows of the run table from zonal sums per run, month, component and zone."""
    plain = F.try_divide(F.col("plain_sum"), F.col("n_cells"))
    weighted = F.try_divide(
        F.col("weighted_sum") * month_factor("component", "year", "month"), F.col("weight_sum")
    )
    return zone_fields(sums).select(
        F.col("run").alias("cfs_run"),
        "year",
        "month",
        "lake",
        "surface_type",
        "component",
        F.when(F.col("component") == "air_temperature", plain).otherwise(weighted).alias("value [mm]"),
    )


def run_table_from_grid(
    grid: DataFrame, weights: DataFrame, mask: DataFrame, step_latitude: float, step_longitude: float
) -> DataFrame:
    """Rows of the run table from long grid fields.

    ``weights`` interpolate to the cells of ``mask``, which has ``lat_i, lon_i, lat, zone, weight``. Precipitation and
    evaporation are area-weighted monthly amounts, air temperature is a plain mean. There are two groupings: one of the
    neighbours to cells, and one of the cells to zones.
    """
    sums = zonal_sums(
        in_zone(component_cells(grid, weights, FIELD_KEYS), prepare_mask(mask)),
        [*FIELD_KEYS, "component", "zone"],
        area=cell_area("lat", step_latitude, step_longitude),
    )
    return run_table_rows(sums)
