"""Delimited text: series with header, files with a comment preamble, tab-separated output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basinspark.functions.numbers import null_if_nan


def nan_to_null(df: DataFrame) -> DataFrame:
    """NULL for every NaN, since Spark aggregates skip NULL but let NaN through."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({name: null_if_nan(F.col(f"`{name}`")) for name in floats}) if floats else df


def read_series(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    sep: str = ",",
    comment: str | None = None,
    name_pattern: str | None = None,
    name_columns: tuple[str, ...] = (),
) -> DataFrame:
    """Read headed text files by an explicit schema.

    ``comment`` skips preamble lines that begin with that character. ``name_pattern`` is a regular expression whose
    groups become the columns ``name_columns``, so that a whole folder of per-lake files is one scan.
    """
    options = {"header": True, "sep": sep, "ignoreLeadingWhiteSpace": True, "ignoreTrailingWhiteSpace": True}
    if comment is not None:
        options["comment"] = comment
    df = nan_to_null(spark.read.schema(schema).options(**options).csv(path))
    if name_pattern is not None:
        file_name = F.col("_metadata.file_name")
        df = df.select(
            "*",
            *[
                F.regexp_extract(file_name, name_pattern, number).alias(name)
                for number, name in enumerate(name_columns, start=1)
            ],
        )
    return df


def write_tsv(df: DataFrame, path: str) -> None:
    """Write a folder of tab-separated files with header."""
    df.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)
