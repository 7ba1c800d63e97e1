"""Numeric helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mean(column: Column | str) -> Column:
    """Arithmetic mean as DOUBLE for any numeric input, NaN left out; NULL for a group without values.

    For integers the sum is exact, so the result does not depend on the order of the rows.
    """
    column = null_if_nan(F.col(column) if isinstance(column, str) else column)
    return F.try_divide(F.sum(column).cast("double"), F.count(column).cast("double"))


def rounded(column: Column, digits: int | None) -> Column:
    """Round half to even, or leave as it is."""
    return column if digits is None else F.bround(column, digits)


def null_if_nan(column: Column) -> Column:
    return F.when(~F.isnan(column), column)
