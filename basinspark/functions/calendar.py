"""Months, forecast runs and their labels as column expressions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Lead columns of the operational forecast files and their offset in months.
LEAD_WORDS = {"one": 0, "two": 1, "three": 2, "four": 3, "five": 4, "six": 5}


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def month_start(year: Column | str, month: Column | str) -> Column:
    """First day of the month. A month outside 1–12 is an error, with or without ANSI mode."""
    year, month = _col(year).cast("int"), _col(month).cast("int")
    return F.when(month.between(1, 12), F.make_date(year, month, F.lit(1))).when(
        month.isNotNull(), F.raise_error(F.lit("Month must be between 1 and 12.")).cast("date")
    )


def month_index(year: Column | str, month: Column | str) -> Column:
    """Months counted from year 0, so that months of different years compare as numbers."""
    return _col(year).cast("int") * 12 + _col(month).cast("int")


def days_in_month(year: Column | str, month: Column | str) -> Column:
    return F.dayofmonth(F.last_day(month_start(year, month)))


def seconds_in_month(year: Column | str, month: Column | str) -> Column:
    return days_in_month(year, month).cast("long") * F.lit(86400)


def month_label(year: Column | str, month: Column | str, sep: str = "-") -> Column:
    """``YYYY<sep>MM`` with zero padding; float years and months (1950.0) are accepted."""
    return _formatted(f"%04d{sep}%02d", _col(year).cast("int"), _col(month).cast("int"))


def parse_month_name(year: Column | str, name: Column | str) -> Column:
    """Month start from a year and an English month abbreviation, which may carry blanks."""
    return F.to_date(F.concat(_col(year).cast("int").cast("string"), F.lit("-"), F.trim(_col(name))), "yyyy-MMM")


def lead_offset(word: Column | str) -> Column:
    """Offset in months of a lead column name; an unknown name gives NULL."""
    return _lookup(LEAD_WORDS)[_col(word)]


def valid_month(start: Column | str, lead: Column | str) -> Column:
    """Month a lead refers to: the forecast date moved on by ``lead`` months."""
    return F.add_months(_col(start), _col(lead).cast("int"))


def month_one_hot(df: DataFrame, month: str, prefix: str = "month") -> DataFrame:
    """Twelve 0/1 columns, always all of them, whatever months occur.

    The columns come from one generated row. As twelve column expressions over the month they would make the optimizer
    derive constraints for every subset of them when the table is later joined on the month.
    """
    flags = [(F.col(month) == number).cast("int").alias(f"{prefix}_{number}") for number in range(1, 13)]
    return df.select("*", F.inline(F.array(F.struct(*flags))))


def run_date(run: Column | str) -> Column:
    """Date of a run identifier ``YYYYMMDDHH``, given as number or text."""
    return F.to_date(F.substring(_col(run).cast("string"), 1, 8), "yyyyMMdd")


def run_hour(run: Column | str) -> Column:
    return F.substring(_col(run).cast("string"), 9, 2).cast("int")


def run_id(moment: Column | str) -> Column:
    """Run identifier ``YYYYMMDDHH`` of a zone-free timestamp, as a number.

    Built from the parts, so that no session time zone is involved.
    """
    moment = _col(moment)
    return (
        F.year(moment).cast("long") * 1000000
        + F.month(moment) * 10000
        + F.dayofmonth(moment) * 100
        + F.hour(moment)
    )


def run_moment(run: Column | str) -> Column:
    """Zone-free timestamp of a run identifier."""
    return run_date(run).cast("timestamp_ntz") + F.make_dt_interval(hours=run_hour(run))


def run_label(day: Column, hour: Column) -> Column:
    """``MM-DD-YYYY HH``."""
    return _formatted("%02d-%02d-%04d %02d", F.month(day), F.dayofmonth(day), F.year(day), hour)


def next_run(run: Column | str) -> Column:
    """Label of the run after ``run``: 18 h rolls to the next day, and any odd hour goes to 06 h."""
    day, hour = run_date(run), run_hour(run)
    following = F.when(hour == 18, 0).when(hour == 12, 18).when(hour == 6, 12).otherwise(6)
    return run_label(F.when(hour == 18, F.date_add(day, 1)).otherwise(day), following)


def run_boundary(label: Column | str, default_hour: int) -> Column:
    """Timestamp of ``MM-DD-YYYY`` or ``MM-DD-YYYY HH``; a missing hour becomes ``default_hour``."""
    label = _col(label)
    day = F.to_date(F.substring(label, 1, 10), "MM-dd-yyyy").cast("timestamp_ntz")
    hour = F.when(F.length(label) == 10, F.lit(default_hour)).otherwise(F.substring(label, 12, 2).cast("int"))
    return day + F.make_dt_interval(hours=hour)


def run_calendar(df: DataFrame, start: str, end: str, out: str = "run_ts", hours: int = 6) -> DataFrame:
    """One row per run between two zone-free timestamps, both ends inclusive; a start after the end gives no rows."""
    step = F.make_dt_interval(hours=F.lit(hours))
    return df.where(F.col(start) <= F.col(end)).withColumn(out, F.explode(F.sequence(start, end, step)))


def missing_runs(
    stored: DataFrame, run: str, as_of: dt.date, by: Sequence[str] = (), hours: int = 6
) -> DataFrame:
    """Runs still to be fetched, per table key ``by``: from the run after the latest one through 18 h of yesterday.

    A table that is up to date gives no rows, and so does an empty one, which has no latest run.
    """
    yesterday = F.lit((as_of - dt.timedelta(days=1)).strftime("%m-%d-%Y"))
    spans = (
        stored.groupBy(*by)
        .agg(F.max(run).alias("_latest"))
        .select(
            *by, run_boundary(next_run("_latest"), 0).alias("_first"), run_boundary(yesterday, 18).alias("_last")
        )
    )
    return run_calendar(spans, "_first", "_last", "_moment", hours).select(*by, run_id("_moment").alias(run))


def run_path(moment: Column | str, prefix: str, suffix: str) -> Column:
    """Folder of a run, ``<prefix>YYYYMMDD/HH<suffix>``."""
    moment = _col(moment)
    return _formatted(
        f"{prefix}%04d%02d%02d/%02d{suffix}",
        F.year(moment),
        F.month(moment),
        F.dayofmonth(moment),
        F.hour(moment),
    )


def _formatted(pattern: str, *parts: Column) -> Column:
    """Formatted text; NULL when any part is NULL, which ``format_string`` would print as a word."""
    whole = parts[0].isNotNull()
    for part in parts[1:]:
        whole = whole & part.isNotNull()
    return F.when(whole, F.format_string(pattern, *parts))


def _lookup(table: dict) -> Column:
    """A literal map of a small dictionary."""
    return F.create_map(*[F.lit(part) for pair in table.items() for part in pair])
