"""What the operators of this subpackage share: words, stable row tests, shared scratch tables."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basinspark.session import fresh_folder

#: White space of the word rule; everything else belongs to a word.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
#: Rows that a task holds at a time where they are whole texts or long arrays; Spark's own numbers are 4,096 and 10,000.
FEW_ROWS = {"spark.sql.parquet.columnarReaderBatchSize": "512", "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; empty for NULL."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other letters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def remainder(key: str, divisor: int) -> Column:
    """crc32 of a key written as text, modulo ``divisor``; a NULL key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % divisor


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, which a lambda body would otherwise repeat for every element."""
    return F.transform(F.array(value), body)[0]


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read again, with its path, so that it can be dropped after its last use."""
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def dropped(spark: SparkSession, *paths: str) -> None:
    """Delete tables of the shared folder that no later plan reads."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)


def sampled(df: DataFrame, rows: int, total: int, key: str) -> DataFrame:
    """About ``rows`` of ``total`` rows (all of them if there are fewer), chosen by a hash of their key.

    Used only to fit models on a bounded number of rows. Reruns agree, whatever the partitioning.
    """
    if total <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 30)) < int((1 << 30) * rows / total))


def sequences_by_time(lengths):
    """For numpy sequences laid end to end: their order by falling length, their starts in it, and how many are as long.

    Dynamic programs over many sequences run one step at a time over all sequences that still have a token there.
    """
    import numpy as np

    lengths = np.asarray(lengths, dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(lengths) else np.zeros(0, np.int64)
    order = np.argsort(-lengths, kind="stable")
    steps = int(lengths.max()) if len(lengths) else 0
    active = np.searchsorted(-lengths[order], -np.arange(1, steps + 1), side="right")
    return order, starts[order], active


def extended(rows: DataFrame, added: str, keep_text: bool = False) -> StructType:
    """The schema of all but the last column (the text), which can stay, followed by the added columns."""
    return StructType(rows.schema.fields[: None if keep_text else -1] + StructType.fromDDL(added).fields)


@contextlib.contextmanager
def few_rows_at_a_time(spark: SparkSession) -> Iterator[None]:
    """Scans and Python tasks of the jobs that run inside hold ``FEW_ROWS`` at a time; the session's own numbers come back."""
    before = {name: spark.conf.get(name) for name in FEW_ROWS}
    for name, most in FEW_ROWS.items():
        spark.conf.set(name, str(min(int(most), int(before[name]) if int(before[name]) > 0 else int(most))))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def give_back() -> None:
    """Return freed memory of this process to the system, where its allocators can."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The task function, after which its worker keeps no freed memory: workers are used again, and wait beside other stages."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task
