"""Missing values and record checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def missing(df: DataFrame, column: str) -> Column:
    """True for NULL, and for NaN in a floating column."""
    name = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return name.isNull() | F.isnan(name)
    return name.isNull()


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without any missing value."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def null_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Number of missing values per column, as one long table."""
    columns = list(columns or df.columns)
    counts = df.agg(*[F.count_if(missing(df, column)).alias(column) for column in columns])
    return counts.unpivot([], [f"`{column}`" for column in columns], "column_name", "n_missing")


def incomplete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with at least one missing value."""
    return df.where(reduce(lambda a, b: a | b, [missing(df, column) for column in columns or df.columns]))


def null_sentinel(df: DataFrame, columns: Sequence[str], sentinel: float, drop: bool = False) -> DataFrame:
    """NULL in place of the sentinel, with the affected rows dropped on request."""
    cleaned = df.withColumns({column: F.nullif(F.col(column), F.lit(sentinel)) for column in columns})
    return cleaned.na.drop(subset=list(columns)) if drop else cleaned


def run_record_rules() -> dict[str, Column]:
    """Conditions a record of the run table must meet."""
    return {
        "year missing": F.col("year").isNotNull(),
        "month outside 1-12": F.coalesce(F.col("month").between(1, 12), F.lit(False)),
        "key missing": F.col("cfs_run").isNotNull()
        & F.col("lake").isNotNull()
        & F.col("surface_type").isNotNull()
        & F.col("component").isNotNull(),
        "value missing": F.col("`value [mm]`").isNotNull(),
    }


def first_broken_rule(rules: Mapping[str, Column]) -> Column:
    """Name of the first rule a row breaks; NULL for a good row. A rule that is NULL counts as broken."""
    return F.coalesce(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()])


def validated(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The rows, with an error as soon as one that breaks a rule is read."""
    broken = first_broken_rule(rules)
    return df.where(F.when(broken.isNull(), F.lit(True)).otherwise(F.raise_error(broken).cast("boolean")))


def split_valid(df: DataFrame, rules: Mapping[str, Column], reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected rows with the name of the first rule they break."""
    judged = df.withColumn(reason, first_broken_rule(rules))
    return judged.where(F.col(reason).isNull()).drop(reason), judged.where(F.col(reason).isNotNull())
