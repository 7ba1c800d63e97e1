"""Reshaping: pivot, unpivot, composite names, basins, closure."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basinspark.functions.names import composite, name_part, recoded
from basinspark.functions.numbers import mean
from basinspark.session import size_checked


def add_composite(df: DataFrame, columns: Sequence[str], out: str, sep: str = "_") -> DataFrame:
    """Composite variable name; NULL when any part is NULL."""
    return df.withColumn(out, composite(*columns, sep=sep))


def split_composite(df: DataFrame, column: str, outs: Sequence[str], sep: str = "_") -> DataFrame:
    """Split a composite name into columns; parts that are missing are NULL."""
    return df.withColumns({out: name_part(column, sep, i) for i, out in enumerate(outs)})


def recode(df: DataFrame, column: str, table: Mapping[str, str] | DataFrame, unknown: str = "error") -> DataFrame:
    """Recode a column by a dictionary, or by a two-column DataFrame for a lookup that is not small.

    Unknown values raise an error, or are kept with ``unknown='keep'``.
    """
    if isinstance(table, Mapping):
        return df.withColumn(column, recoded(column, table, unknown))
    source, target = table.columns
    lookup = size_checked(table.select(F.col(source).alias(column), F.col(target).alias("_found")))
    found = df.join(lookup, column, "left")
    other = (
        F.col(column)
        if unknown == "keep"
        else F.raise_error(F.concat(F.lit("No entry for "), F.col(column).cast("string"))).cast("string")
    )
    return found.withColumn(column, F.coalesce("_found", other)).drop("_found").select(*df.columns)


def to_wide(
    df: DataFrame,
    index: Sequence[str],
    column: str,
    names: Sequence,
    value: str,
    prefix: str = "",
    fill: float | None = None,
) -> DataFrame:
    """Pivot with an explicit list of columns, all of which exist in the result; repeated cells are averaged.

    Index rows whose values are all NULL do not appear, as they have no cell.
    """
    cells = {f"{prefix}{name}": mean(F.when(F.col(column) == name, F.col(f"`{value}`"))) for name in names}
    if fill is not None:
        cells = {name: F.coalesce(cell, F.lit(fill)) for name, cell in cells.items()}
    return (
        df.na.drop(subset=[*index, value])
        .where(F.col(column).isin(*names))
        .groupBy(*index)
        .agg(*[cell.alias(name) for name, cell in cells.items()])
    )


def to_long(df: DataFrame, ids: Sequence[str], columns: Sequence[str], variable: str, value: str) -> DataFrame:
    """Unpivot the given columns."""
    return df.unpivot(list(ids), [f"`{column}`" for column in columns], variable, value)


def wide_to_records(
    df: DataFrame,
    ids: Sequence[str],
    parts: Sequence[str],
    value: str,
    recodes: Mapping[str, Mapping[str, str]] | None = None,
    sep: str = "_",
) -> DataFrame:
    """Rows of key and value from a wide file whose column names carry the key parts; unknown codes are kept."""
    columns = [name for name in df.columns if name not in ids]
    long = split_composite(to_long(df, ids, columns, "_name", value), "_name", parts, sep)
    for part, table in (recodes or {}).items():
        long = recode(long, part, table, unknown="keep")
    return long.select(*ids, *parts, value)


def ensure_columns(df: DataFrame, names: Sequence[str], fill: float = 0) -> DataFrame:
    """Add the columns that are missing, with a constant."""
    missing = {name: F.lit(fill) for name in names if name not in df.columns}
    return df.withColumns(missing) if missing else df


def columns_like(df: DataFrame, prefix: str = "", suffix: str = "") -> list[str]:
    """Column names by prefix and suffix."""
    return [name for name in df.columns if name.startswith(prefix) and name.endswith(suffix)]


def paired_columns(df: DataFrame, suffix: str, observed_suffix: str) -> dict[str, str]:
    """Predictor columns with the observation column of the same lake, for those lakes that have one."""
    pairs = {name: name.removesuffix(suffix) + observed_suffix for name in columns_like(df, suffix=suffix)}
    return {name: other for name, other in pairs.items() if other in df.columns}


def merge_basins(df: DataFrame, keep: Sequence[str], spec: Mapping[str, tuple]) -> DataFrame:
    """Wide basin arithmetic. ``spec`` maps an output to ``('total', columns, area)`` or ``('mean', columns)``.

    ``total`` adds mass columns [kg] and divides by an area [m2], which gives mm; ``mean`` averages the columns.
    """

    def combined(how: str, columns: Sequence[str], area: float | None = None) -> Column:
        added = F.col(f"`{columns[0]}`")
        for column in columns[1:]:
            added = added + F.col(f"`{column}`")
        if how == "total":
            return added / F.lit(float(area))
        if how == "mean":
            return added / F.lit(float(len(columns)))
        raise ValueError("how must be 'total' or 'mean'")

    return df.select(*keep, *[combined(*entry).alias(out) for out, entry in spec.items()])


def closure(precipitation: Column, evaporation: Column, runoff: Column) -> Column:
    """Net basin supply from its components."""
    return precipitation - evaporation + runoff


def closure_gap(
    df: DataFrame, keys: Sequence[str], component: str, value: str, total: str = "cnbs"
) -> DataFrame:
    """Published net supply against the sum of its components, per key of a long table.

    A missing component leaves the computed supply and the gap NULL.
    """

    def of(name: str) -> Column:
        return F.sum(F.when(F.col(component) == name, F.col(f"`{value}`")))

    return (
        df.groupBy(*keys)
        .agg(
            of(total).alias("published"),
            closure(of("precipitation"), of("evaporation"), of("runoff")).alias("computed"),
        )
        .withColumn("gap", F.col("published") - F.col("computed"))
    )
