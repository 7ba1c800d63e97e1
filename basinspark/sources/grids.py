"""Long grid tables: scan by run, variable and level, with alternative variable names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basinspark.functions.names import recoded


def select_fields(
    grid: DataFrame,
    variables: Sequence[str],
    run: int | None = None,
    level_type: str | None = None,
    level: int | None = None,
) -> DataFrame:
    """Fields of one run and level. All tests are plain comparisons, so they reach the scan."""
    chosen = F.col("variable").isin(*variables)
    for column, wanted in (("run", run), ("level_type", level_type), ("level", level)):
        if wanted is not None:
            chosen = chosen & (F.col(column) == wanted)
    return grid.where(chosen)


def one_name(grid: DataFrame, names: Mapping[str, str], variable: str = "variable") -> DataFrame:
    """Give alternative variable names one name; other names are kept."""
    return grid.withColumn(variable, recoded(variable, names, unknown="keep"))


def preferred_variable(
    grid: DataFrame, keys: Sequence[str], alternatives: Sequence[str], out: str, variable: str = "variable"
) -> DataFrame:
    """For each key the value of the first alternative that is present, under the name ``out``.

    The choice is a conditional maximum, which is combined before the shuffle.
    """
    found = [F.max(F.when(F.col(variable) == name, F.col("value"))) for name in alternatives]
    return (
        grid.where(F.col(variable).isin(*alternatives))
        .groupBy(*keys)
        .agg(F.coalesce(*found).alias("value"))
        .withColumn(variable, F.lit(out))
    )


def preferred_column(df: DataFrame, alternatives: Sequence[str], out: str) -> DataFrame:
    """The first of several alternative columns that the table has; none of them is an error."""
    present = [name for name in alternatives if name in df.columns]
    if not present:
        raise ValueError(f"None of {list(alternatives)} is a column.")
    return df.withColumn(out, F.coalesce(*[F.col(f"`{name}`") for name in present]))
