"""Table schemas and the fixed values of the forecasting domain."""

from __future__ import annotations

from pyspark.sql import types as T

RUN_TABLE = T.StructType(
    [
        T.StructField("cfs_run", T.LongType(), False),
        T.StructField("year", T.IntegerType(), False),
        T.StructField("month", T.IntegerType(), False),
        T.StructField("lake", T.StringType(), False),
        T.StructField("surface_type", T.StringType(), False),
        T.StructField("component", T.StringType(), False),
        T.StructField("value [mm]", T.DoubleType(), True),
    ]
)
RUN_KEY = ["cfs_run", "year", "month", "lake", "surface_type", "component"]

POSTERIOR_OBSERVATIONS = T.StructType(
    [T.StructField(name, T.DoubleType()) for name in ("Year", "Month", "Median", "2.5 Percentile", "97.5 Percentile")]
)

# Month abbreviations of the residual-supply files.
MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

RESIDUAL_OBSERVATIONS = T.StructType(
    [T.StructField("Year", T.IntegerType())] + [T.StructField(name, T.DoubleType()) for name in MONTH_NAMES]
)

GRID_TABLE = T.StructType(
    [
        T.StructField("run", T.LongType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("variable", T.StringType()),
        T.StructField("level_type", T.StringType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("lat_i", T.IntegerType()),
        T.StructField("lon_i", T.IntegerType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("value", T.DoubleType()),
    ]
)

MASK_TABLE = T.StructType(
    [
        T.StructField("lat_i", T.IntegerType()),
        T.StructField("lon_i", T.IntegerType()),
        T.StructField("zone", T.StringType()),
        T.StructField("weight", T.DoubleType()),
    ]
)

# Mask prefixes and component codes with their full names.
LAKE_NAMES = {"eri": "erie", "ont": "ontario", "sup": "superior", "mih": "michigan-huron"}
COMPONENT_NAMES = {"tmp": "air_temperature", "pcp": "precipitation", "evap": "evaporation"}

# Lake surface areas [m2] for converting published forecasts.
LAKE_AREAS = {
    "superior": 82097e6,
    "michigan-huron": (57753 + 59560) * 1e6,
    "erie": 25655e6,
    "ontario": 19009e6,
}

# Lake and land areas [m2] measured on the mask, used for verification.
MASK_LAKE_AREAS = {
    "erie": 18596386416.712486,
    "ontario": 15569248531.837788,
    "michigan-huron": 123626283030.46616,
    "superior": 78288645587.81192,
}

# Order of lakes, surfaces and components in the feature and target tables.
FEATURE_LAKES = ["superior", "erie", "ontario", "michigan-huron"]
SURFACES = ["lake", "land"]
PREDICTOR_COMPONENTS = ["precipitation", "evaporation", "air_temperature"]
TARGET_COMPONENTS = ["evaporation", "precipitation", "runoff", "cnbs"]

PREDICTORS = [
    f"{lake}_{surface}_{component}"
    for component in PREDICTOR_COMPONENTS
    for surface in SURFACES
    for lake in FEATURE_LAKES
]
MONTH_INDICATORS = [f"month_{month}" for month in range(1, 13)]
FEATURES = PREDICTORS + MONTH_INDICATORS
TARGETS = [f"{lake}_{component}" for lake in FEATURE_LAKES for component in TARGET_COMPONENTS]

# Skill groups and the components each one pools.
SKILL_GROUPS = {
    "All": ["precipitation", "evaporation", "runoff", "cnbs"],
    "Components": ["precipitation", "evaporation", "runoff"],
    "Precipitation": ["precipitation"],
    "Evaporation": ["evaporation"],
    "Runoff": ["runoff"],
    "CNBS": ["cnbs"],
}
