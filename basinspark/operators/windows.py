"""Lagged and leading columns of ordered series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basinspark.operators.groups import SMALL_GROUP
from basinspark.operators.positions import with_position


def lag_lead(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    lag: int = 0,
    lead: int = 0,
    small_group: int = SMALL_GROUP,
) -> DataFrame:
    """Values of the rows before and after in the same series, as ``<column>_mo-<k>`` and ``<column>_mo<k>``.

    Shifts count rows, not months. Rows with any missing value are dropped; with ``lag = lead = 0`` that is all that
    happens. Where a series has more than ``small_group`` rows, all rows are sorted and written once, and cut into chunks of
    that size, each with the neighbouring rows its shifts need, so that no window group is larger than that.
    """
    if lag == 0 and lead == 0:
        return df.na.drop("any")
    # Rows without a series go in any case, and no other row looks at them.
    named = df.na.drop(subset=list(series)) if series else df
    sizes = named.groupBy(*series).agg(F.count(F.lit(1)).alias("_rows"))
    if sizes.where(F.col("_rows") > small_group).isEmpty():
        return _shifted(named, [*series], order, columns, lag, lead).na.drop("any")
    return _shifted_in_chunks(named, series, order, columns, lag, lead, small_group).na.drop("any")


def _shifted(
    df: DataFrame, group: Sequence[str], order: Sequence[str], columns: Sequence[str], lag: int, lead: int
) -> DataFrame:
    window = Window.partitionBy(*(group or [F.lit(0)])).orderBy(*order)
    shifted = {}
    for column in columns:
        for k in range(1, lag + 1):
            shifted[f"{column}_mo-{k}"] = F.lag(f"`{column}`", k).over(window)
        for k in range(1, lead + 1):
            shifted[f"{column}_mo{k}"] = F.lead(f"`{column}`", k).over(window)
    return df.withColumns(shifted)


def _shifted_in_chunks(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    lag: int,
    lead: int,
    chunk: int,
) -> DataFrame:
    at = F.col("_at")
    spread = with_position(df, [*series, *order], "_at").withColumn(
        "_chunk", F.explode(F.sequence(F.floor((at - lead) / chunk), F.floor((at + lag) / chunk)))
    )
    shifted = _shifted(spread, [*series, "_chunk"], ["_at"], columns, lag, lead)
    return shifted.where(F.col("_chunk") == F.floor(at / chunk)).drop("_at", "_chunk")


def lag_lead_by_month(
    df: DataFrame, series: Sequence[str], month: str, columns: Sequence[str], lag: int = 0, lead: int = 0
) -> DataFrame:
    """As :func:`lag_lead`, but by calendar month, so that a gap in the months gives no value.

    Every row is sent to the months that want it and the rows of one month are folded together: one shuffle on
    (series, month) for any number of shifts. ``month`` is a month start and is unique within its series.
    """
    offsets = [k for k in range(-lead, lag + 1)]
    sent = df.select(
        *series,
        F.col(month).alias("_from"),
        *columns,
        F.explode(F.array(*[F.lit(k) for k in offsets])).alias("_k"),
    ).withColumn(month, F.add_months("_from", F.col("_k")))
    cells = {}
    for column in columns:
        cells[column] = F.max(F.when(F.col("_k") == 0, F.col(column)))
        for k in range(1, lag + 1):
            cells[f"{column}_mo-{k}"] = F.max(F.when(F.col("_k") == k, F.col(column)))
        for k in range(1, lead + 1):
            cells[f"{column}_mo{k}"] = F.max(F.when(F.col("_k") == -k, F.col(column)))
    return sent.groupBy(*series, month).agg(*[cell.alias(name) for name, cell in cells.items()]).na.drop("any")
