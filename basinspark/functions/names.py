"""Composite names and recoding."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def mapped(value: Column | str, table: Mapping) -> Column:
    """Look a value up in a small literal table; NULL when it is not there."""
    value = F.col(value) if isinstance(value, str) else value
    return F.create_map(*[F.lit(part) for pair in table.items() for part in pair])[value]


def recoded(value: Column | str, table: Mapping, unknown: str = "error") -> Column:
    """Recode by a literal table. An unknown value is an error, or is kept when ``unknown='keep'``."""
    value = F.col(value) if isinstance(value, str) else value
    found = mapped(value, table)
    if unknown == "keep":
        return F.coalesce(found, value)
    if unknown != "error":
        raise ValueError("unknown must be 'error' or 'keep'")
    complaint = F.concat(F.lit("No entry for "), F.coalesce(value.cast("string"), F.lit("NULL")))
    return F.coalesce(found, F.raise_error(complaint).cast("string"))


def composite(*parts: Column | str, sep: str = "_") -> Column:
    """Join name parts with a separator; NULL when any part is NULL."""
    columns = [F.col(part) if isinstance(part, str) else part for part in parts]
    pieces = [columns[0]]
    for column in columns[1:]:
        pieces += [F.lit(sep), column]
    return F.concat(*pieces)


def name_part(value: Column | str, sep: str, index: int) -> Column:
    """Part ``index`` of a separated name, counted from 0; NULL when there are fewer parts."""
    value = F.col(value) if isinstance(value, str) else value
    return F.get(F.split(value, "\\Q" + sep + "\\E"), index)
