"""Delimited files whose preamble is known by its number of lines only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basinspark.sources.delimited import nan_to_null


def _below_preamble(skip: int):
    """Task function: lines with the file and block they stand in, without the first ``skip`` lines of each file.

    A task reads its pieces of files one after the other, each from its first line on, and only the piece at the start of
    a file has lines to leave out. So nothing is counted across tasks, and files of any size are split as usual; the
    preamble must end within the first piece.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, seen = None, 0
        for batch in batches:
            files, starts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            kept = []
            for file, start in zip(files, starts, strict=True):
                if (file, start) != place:
                    place, seen = (file, start), 0
                kept.append(start > 0 or seen >= skip)
                seen += 1
            yield batch.select([0, 1]).filter(pa.array(kept, pa.bool_()))

    return run


def read_below(
    spark: SparkSession, path: str | list[str], schema: T.StructType, skip_lines: int, sep: str = ",", name_pattern: str | None = None, name_columns: tuple[str, ...] = ()
) -> DataFrame:
    """Rows of delimited files below ``skip_lines`` lines and a header line; blank lines are left out.

    ``name_pattern`` is a regular expression whose groups become the columns ``name_columns``, from the name of the file.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    rows = lines.mapInArrow(_below_preamble(skip_lines + 1), "value string, file string").where(F.trim(F.regexp_replace("value", "\r", "")) != "")
    options = {"sep": sep, "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    parsed = rows.select("file", F.from_csv(F.regexp_replace("value", "\r$", ""), schema.simpleString()[7:-1].replace(":", " "), options).alias("row"))
    names = [F.regexp_extract("file", name_pattern, number).alias(name) for number, name in enumerate(name_columns, start=1)] if name_pattern else []
    return nan_to_null(parsed.select("row.*", *names))
