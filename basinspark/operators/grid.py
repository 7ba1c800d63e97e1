"""Crop, regrid and zonal reduction of long grid tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basinspark.functions.calendar import days_in_month
from basinspark.functions.names import name_part, recoded
from basinspark.functions.numbers import mean, null_if_nan
from basinspark.schemas import LAKE_NAMES
from basinspark.session import broadcast_if_small, persisted, size_checked

#: Pairs of field row and weight that one task joins and sums where they are dealt by target.
TASK_PAIRS = 1_000_000
#: Targets per cell up to which small weights are broadcast; beyond it a few rows of the field make too many pairs.
MOST_TARGETS = 64


def crop(
    grid: DataFrame, mask: DataFrame, lat: str = "lat", lon: str = "lon", pad_lat: float = 0.0, pad_lon: float = 0.0
) -> DataFrame:
    """Cells inside the extent of the mask, ends included, widened by a margin.

    One cell of margin keeps the neighbours that :func:`regrid` needs at the edge. The bounds are scalar subqueries
    with the margin inside, so that the scan can compare each column with one value and skip row groups.
    """
    chosen = F.lit(True)
    for column, pad in ((lat, pad_lat), (lon, pad_lon)):
        low, high = mask.agg(F.min(column) - pad).scalar(), mask.agg(F.max(column) + pad).scalar()
        chosen = chosen & F.col(column).between(low, high)
    return grid.where(chosen)


def bilinear_weights(
    points: DataFrame,
    lat_start: float,
    lat_step: float,
    n_lat: int,
    lon_start: float,
    lon_step: float,
    n_lon: int,
    target: Sequence[str] = ("lat_i", "lon_i"),
    lat: str = "lat",
    lon: str = "lon",
) -> DataFrame:
    """Interpolation weights of target points on a regular source grid.

    One row per target and neighbour: target…, ``src_lat_i``, ``src_lon_i``, the weight ``w``, its ``corner`` (0 to 3)
    and ``n_sources``, the number of neighbours of the target. The neighbours follow from the axes by arithmetic, so no distance join is
    needed; a step may be negative. Only neighbours with a weight above 0 are listed. A point outside the source has no
    rows.
    """
    row = (F.col(lat) - F.lit(lat_start)) / F.lit(lat_step)
    column = (F.col(lon) - F.lit(lon_start)) / F.lit(lon_step)
    placed = (
        points.select(*target, row.alias("_y"), column.alias("_x"))
        .where(F.col("_y").between(0, n_lat - 1) & F.col("_x").between(0, n_lon - 1))
        .withColumns({"_i": F.floor("_y").cast("int"), "_j": F.floor("_x").cast("int")})
        .withColumns({"_fy": F.col("_y") - F.col("_i"), "_fx": F.col("_x") - F.col("_j")})
    )
    corners = [
        F.struct(
            (F.col("_i") + di).alias("src_lat_i"),
            (F.col("_j") + dj).alias("src_lon_i"),
            ((F.col("_fy") if di else 1 - F.col("_fy")) * (F.col("_fx") if dj else 1 - F.col("_fx"))).alias("w"),
            F.lit(2 * di + dj).alias("corner"),
        )
        for di in (0, 1)
        for dj in (0, 1)
    ]
    # A point on a grid line needs one neighbour across it, and any other point two.
    n_sources = F.when(F.col("_fy") > 0, 2).otherwise(1) * F.when(F.col("_fx") > 0, 2).otherwise(1)
    return placed.select(*target, n_sources.alias("n_sources"), F.inline(F.array(*corners))).where("w > 0")


def interpolated(value: Column) -> Column:
    """Aggregate of weighted neighbours: the value at the target, NULL unless every neighbour has a value.

    For rows of a field joined to :func:`bilinear_weights`, with ``_w``, ``_corner`` and ``_needed``. Repeated values of
    a neighbour are averaged.
    """
    total, found = F.lit(0.0), F.lit(0)
    for corner in range(4):
        own = F.when(F.col("_corner") == corner, value)
        total = total + F.coalesce(F.max(F.when(F.col("_corner") == corner, F.col("_w"))) * F.avg(own), F.lit(0.0))
        found = found + F.when(F.count(own) > 0, 1).otherwise(0)
    return F.when(found == F.max("_needed"), total)


def weighted_neighbours(
    grid: DataFrame,
    weights: DataFrame,
    columns: Sequence[str | Column],
    target: Sequence[str] = ("lat_i", "lon_i"),
    source: Sequence[str] = ("lat_i", "lon_i"),
) -> DataFrame:
    """The field once per target that a cell is a neighbour of, cropped to the cells that any target needs.

    The weights are written when this is called, and broadcast if they are small and name few targets per cell, which holds
    for any regional mask. The bounds of their cells are scalar subqueries, so the scan of the field can skip row groups.
    Other weights are dealt by target, see :func:`_dealt`.
    """
    written = persisted(
        weights.select(
            *[F.col(name).alias(f"_t{i}") for i, name in enumerate(target)],
            F.col("src_lat_i").alias("_sy"),
            F.col("src_lon_i").alias("_sx"),
            F.col("w").alias("_w"),
            F.col("corner").alias("_corner"),
            F.col("n_sources").alias("_needed"),
        )
    )
    table = broadcast_if_small(written)
    extent = written.select(F.col("_sy").alias(source[0]), F.col("_sx").alias(source[1]))
    field = crop(grid, extent, source[0], source[1]).select(
        *columns, F.col(source[0]).alias("_sy"), F.col(source[1]).alias("_sx")
    )
    per_cell = written.groupBy("_sy", "_sx").agg(F.count(F.lit(1)).alias("n")).agg(F.avg("n")).first()[0] or 0
    if table is written or per_cell > MOST_TARGETS:
        return _dealt(field, written, [f"_t{i}" for i in range(len(target))])
    return field.join(table, ["_sy", "_sx"])


def _dealt(field: DataFrame, weights: DataFrame, names: Sequence[str]) -> DataFrame:
    """The join of field and weights in tasks that make about ``TASK_PAIRS`` rows each, however many share a cell.

    The field is written when this is called, and the pairs are counted per cell. A small field goes to all tasks, and all
    neighbours of a target meet in one of them. Otherwise the targets of a cell are dealt over as many slices as its pairs
    ask for, and each row of the field goes to the slices of its cell.
    """
    cells = ["_sy", "_sx"]
    field = persisted(field)
    near = weights.groupBy(*cells).agg(F.count(F.lit(1)).alias("_near"))
    counts = field.groupBy(*cells).agg(F.count(F.lit(1)).alias("_rows")).join(near, cells).withColumn("_pairs", F.col("_rows") * F.col("_near"))
    pairs = counts.agg(F.sum("_pairs")).first()[0] or 0
    tasks = max(1, -(-pairs // TASK_PAIRS))
    small = broadcast_if_small(field)
    if small is not field:
        return weights.repartition(tasks, *names).join(small, cells)
    slices = size_checked(counts.select(*cells, F.ceil(F.col("_pairs") / TASK_PAIRS).cast("int").alias("_slices")))
    dealt = weights.join(slices, cells).withColumn("_slice", F.pmod(F.xxhash64(*names), F.col("_slices")).cast("int")).drop("_slices")
    copied = field.join(slices, cells).withColumn("_slice", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1))).drop("_slices")
    keys = [*cells, "_slice"]
    return copied.repartition(tasks, *keys).join(dealt.repartition(tasks, *keys), keys).drop("_slice")


def regrid(
    grid: DataFrame,
    weights: DataFrame,
    keys: Sequence[str],
    value: str = "value",
    target: Sequence[str] = ("lat_i", "lon_i"),
    source: Sequence[str] = ("lat_i", "lon_i"),
) -> DataFrame:
    """Interpolated value per key and target point; NULL unless every neighbour with a weight has a value.

    A target whose neighbours have no value at all has no row. NULL and NaN are no values, and repeated values of a cell
    are averaged. The field is joined to the weights of :func:`bilinear_weights` on the source cell and summed per
    target: a sparse matrix product.
    """
    number = null_if_nan(F.col(value))
    near = weighted_neighbours(grid, weights, [*keys, number.alias("_v")], target, source).where("_v IS NOT NULL")
    names = [f"_t{i}" for i in range(len(target))]
    cells = near.groupBy(*keys, *names).agg(interpolated(F.col("_v")).alias(value))
    return cells.select(*keys, *[F.col(t).alias(name) for t, name in zip(names, target, strict=True)], value)


def zone_fields(df: DataFrame, zone: str = "zone") -> DataFrame:
    """Lake and surface of a zone name such as ``eri_lake``; an unknown prefix is an error."""
    return df.withColumns(
        {"lake": recoded(name_part(zone, "_", 0), LAKE_NAMES), "surface_type": name_part(zone, "_", 1)}
    )


def prepare_mask(mask: DataFrame) -> DataFrame:
    """Cells inside a zone; a NULL, NaN or 0 weight is outside. Written when this is called, broadcast if it is small."""
    return size_checked(mask.where(null_if_nan(F.col("weight")) != 0))


def in_zone(grid: DataFrame, mask: DataFrame, cell: Sequence[str] = ("lat_i", "lon_i")) -> DataFrame:
    """Cells once per zone they belong to, by a mask of :func:`prepare_mask`."""
    return grid.join(mask, list(cell))


def zonal_sums(
    cells: DataFrame, keys: Sequence[str], value: str = "value", area: Column | str = "area"
) -> DataFrame:
    """Sums from which zonal means follow; they add up over any split of the cells.

    All sums run over the same cells, those with a value; NaN is none.
    """
    area = F.col(area) if isinstance(area, str) else area
    number = null_if_nan(F.col(value))
    weight = F.when(number.isNotNull(), F.col("weight") * area)
    return cells.groupBy(*keys).agg(
        F.sum(number * F.col("weight") * area).alias("weighted_sum"),
        F.sum(weight).alias("weight_sum"),
        F.sum(number).alias("plain_sum"),
        F.count(number).alias("n_cells"),
    )


def zonal_mean(
    cells: DataFrame,
    keys: Sequence[str],
    value: str = "value",
    area: Column | str = "area",
    factor: Column | float = 1.0,
    out: str = "value",
) -> DataFrame:
    """Area-weighted zonal mean times a factor that depends on the keys only."""
    factor = F.lit(factor) if isinstance(factor, (int, float)) else factor
    sums = zonal_sums(cells, keys, value, area)
    return sums.select(
        *keys, F.try_divide(F.col("weighted_sum") * factor, F.col("weight_sum")).alias(out)
    )


def zonal_plain_mean(cells: DataFrame, keys: Sequence[str], value: str = "value", out: str = "value") -> DataFrame:
    """Unweighted mean over the cells of each zone."""
    return cells.groupBy(*keys).agg(mean(value).alias(out))


def month_factor(component: Column | str, year: Column | str, month: Column | str) -> Column:
    """From a stored rate to the monthly amount: four 6-hour amounts a day, or a rate per second; else 1."""
    component = F.col(component) if isinstance(component, str) else component
    days = days_in_month(year, month)
    return (
        F.when(component == "precipitation", 4.0 * days)
        .when(component == "evaporation", 86400.0 * days)
        .otherwise(F.lit(1.0))
    )


def expected_combinations(
    run_table: DataFrame, components: Sequence[str], zones: Sequence[tuple[str, str]]
) -> DataFrame:
    """Missing (component, lake, surface) values of each run and month that has any value.

    Each run and month is expanded by a literal list and checked by an anti join.
    """
    wanted = F.array(
        *[
            F.struct(F.lit(lake).alias("lake"), F.lit(surface).alias("surface_type"), F.lit(name).alias("component"))
            for name in components
            for lake, surface in zones
        ]
    )
    keys = ["cfs_run", "year", "month", "lake", "surface_type", "component"]
    return (
        run_table.select("cfs_run", "year", "month")
        .distinct()
        .select("cfs_run", "year", "month", F.inline(wanted))
        .join(run_table.select(*keys), keys, "left_anti")
    )
