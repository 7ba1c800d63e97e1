"""Unit conversions and physical rates as column expressions."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from basinspark.functions.calendar import _col, seconds_in_month
from basinspark.functions.names import mapped

# Earth radius [m], and the linear fit of the latent heat of vaporisation [MJ/kg] over Celsius.
EARTH_RADIUS = 6371000.0
LATENT_HEAT_AT_ZERO = 2.501
LATENT_HEAT_SLOPE = 0.002361
KELVIN_OFFSET = 273.15


def area_of(lake: Column | str, areas: Mapping[str, float], default: float | None = 0.0) -> Column:
    """Area of a lake from a table of areas [m2]; an unknown lake gets ``default``."""
    area = mapped(lake, areas)
    return area if default is None else F.coalesce(area, F.lit(default))


def mm_to_cms(
    value: Column | str, lake: Column | str, year: Column | str, month: Column | str, areas: Mapping[str, float]
) -> Column:
    """Monthly depth [mm] to mean flow [m3/s]; an unknown lake has area 0 and so flow 0."""
    return _col(value) / 1000 * area_of(lake, areas) / seconds_in_month(year, month)


def cms_to_mm(
    value: Column | str, lake: Column | str, year: Column | str, month: Column | str, areas: Mapping[str, float]
) -> Column:
    """Mean flow [m3/s] to monthly depth [mm]; the value of an unknown lake is left as it is."""
    area = area_of(lake, areas, default=None)
    return F.when(
        area.isNotNull() & (area != 0), _col(value) * seconds_in_month(year, month) / area * 1000
    ).otherwise(_col(value))


def evaporation_rate(temperature: Column | str, latent_heat: Column | str) -> Column:
    """Evaporation [kg/m2/s] from air temperature [K] and latent heat flux [W/m2]."""
    per_kilogram = F.lit(LATENT_HEAT_AT_ZERO) - F.lit(LATENT_HEAT_SLOPE) * (_col(temperature) - KELVIN_OFFSET)
    return _col(latent_heat) * 1e-6 / per_kilogram


def cell_area(latitude: Column | str, step_latitude: float, step_longitude: float) -> Column:
    """Area [m2] of a cell of a regular grid; the sign of the steps does not matter."""
    scale = EARTH_RADIUS**2 * abs(math.radians(step_latitude) * math.radians(step_longitude))
    return F.lit(scale) * F.cos(F.radians(_col(latitude)))
