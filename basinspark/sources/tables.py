"""Keyed tables on parquet: scan, upsert, strict insert, append, lookup, retention.

Upserts, strict inserts and deletes go through :mod:`basinspark.sources.publish`, so a lost writer leaves the old or the
new table. Read such tables with :func:`read_table`.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basinspark.session import persisted
from basinspark.sources import key_index
from basinspark.sources.delimited import nan_to_null
from basinspark.sources.publish import file_name, keep_schema, kept_schema, place_in, publish, recover

# Up to so many touched partitions, the values of their columns prune the scan as lists of literals.
LITERAL_PARTITIONS = 5000


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A stored table, with the types it was first written with; NaN is read as NULL.

    An interrupted change of the table is finished first.
    """
    recover(spark, path)
    schema = schema or kept_schema(spark, path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return nan_to_null(reader.parquet(path))


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def latest_by_key(df: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """The row with the highest sequence number of each key; of rows with equal numbers the one with the highest values.

    Spark keeps one row per key and task before the shuffle (window group limit), so a key that holds a large part of
    the rows reaches its reducer as a few rows.
    """
    others = [f.name for f in df.schema.fields if f.name not in (*keys, sequence) and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    newest = Window.partitionBy(*keys).orderBy(F.col(sequence).desc(), *[F.col(f"`{c}`").desc() for c in others])
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def upserted(target: DataFrame, batch: DataFrame, keys: Sequence[str], sequence: str | None = None) -> DataFrame:
    """``target`` with the rows of ``batch`` put in place of the rows with the same key.

    With ``sequence`` a key may occur more than once in the batch and its last row wins. The target is only probed by
    an anti join and is not shuffled when the batch is small enough for Spark to broadcast its keys.
    """
    if sequence is not None:
        batch = latest_by_key(batch, keys, sequence).drop(sequence)
    return target.join(batch.select(*keys), list(keys), "left_anti").unionByName(batch)


def _no_repeats(batch: DataFrame, keys: Sequence[str]) -> None:
    broken = duplicate_keys(batch, keys).limit(5).collect()
    if broken:
        raise ValueError(f"Duplicate keys in the batch, for instance {[row.asDict() for row in broken]}")


def _stored(spark: SparkSession, path: str, batch: DataFrame, partition_by: Sequence[str]) -> DataFrame | None:
    """The table, its partition columns of the types of the batch; None if there is none yet."""
    try:
        found = spark.read.parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    schema = T.StructType([batch.schema[f.name] if f.name in partition_by else f for f in found.fields])
    return spark.read.schema(kept_schema(spark, path) or schema).parquet(path)


def _only_partitions(target: DataFrame, touched: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The rows of the partitions that ``touched`` names, with one list of literals per column to prune the scan."""
    listed = touched.limit(LITERAL_PARTITIONS + 1).collect()
    if len(listed) <= LITERAL_PARTITIONS:
        for c in partition_by:  # one list per column prunes partitions, however many are touched
            values = {row[c] for row in listed}
            inside = F.col(c).isin(*[v for v in values if v is not None])
            target = target.where(inside | F.col(c).isNull() if None in values else inside)
    if len(listed) > LITERAL_PARTITIONS or len(partition_by) > 1:
        same = [target[c].eqNullSafe(touched[c]) for c in partition_by]
        target = target.join(touched, reduce(lambda a, b: a & b, same), "left_semi")
    return target


def upsert_into(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str],
    sequence: str | None = None,
) -> None:
    """Upsert a batch into a partitioned table and rewrite only the partitions it touches.

    ``partition_by`` must be part of the key. Repeating a batch gives the same table. The batch is written first, as it
    is read for the touched partitions, the key probe and the result; without ``sequence`` a repeated key is an error.
    """
    if not set(partition_by) <= set(keys):
        raise ValueError("Partition columns must be key columns.")
    if sequence is not None:
        batch = latest_by_key(batch, keys, sequence).drop(sequence)
    batch = persisted(batch)
    if sequence is None:
        _no_repeats(batch, keys)
    recover(spark, path, discard=True)
    target = _stored(spark, path, batch, partition_by)
    if key_index.has_index(spark, path):
        key_index.add_segment(batch, path, keys, partition_by)
    if target is None:
        publish(spark, path, batch.hint("rebalance", *partition_by), partition_by=partition_by)
        keep_schema(spark, path, batch.schema)
        return
    target = target.select(*batch.columns, F.col("_metadata.file_path").alias("_file"))
    target = _only_partitions(target, batch.select(*partition_by).distinct(), partition_by)
    old = [file_name(spark, r["_file"]) for r in target.select("_file").distinct().collect()]  # files to be replaced
    rows = upserted(target.drop("_file"), batch, keys).hint("rebalance", *partition_by)
    publish(spark, path, rows, old, partition_by)


def duplicate_keys(df: DataFrame, keys: Sequence[str], count: str = "n_rows") -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).where(F.col(count) > 1)


def insert_conflicts(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the batch that break a strict insert: already in the target, or repeated in the batch."""
    counted = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    stored = target.select(*keys).withColumn("_stored", F.lit(True))
    present = counted.join(stored, list(keys), "left_semi").select(*keys, F.lit("already stored").alias("reason"))
    repeated = counted.where("_n > 1").select(*keys, F.lit("repeated in batch").alias("reason"))
    return present.unionByName(repeated)


def may_hold(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], partition_by: Sequence[str] = ()) -> DataFrame | None:
    """The partitions of a table that may hold a key of the batch, by its key index; None if no partition can."""
    names = key_index.candidates(spark, path, batch, keys, partition_by)
    target = _stored(spark, path, batch, partition_by)
    if not names or target is None:
        return None
    if not partition_by:
        return target
    found = [json.loads(name) for name in names]
    rows = spark.createDataFrame([tuple(f.get(c) for c in partition_by) for f in found], T.StructType([T.StructField(c, T.StringType()) for c in partition_by]))
    touched = rows.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in partition_by])
    return _only_partitions(target, touched, partition_by)


def strict_insert(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], partition_by: Sequence[str] = ()) -> None:
    """Add a batch to a table, or fail and write nothing when one of its keys exists already. The first batch founds it.

    A key index of the table says which partitions can hold a key of the batch, and only these are read; without such a
    partition no stored row is. A table that has no index yet gets one, which reads its keys once.
    """
    batch = persisted(batch)
    _no_repeats(batch, keys)
    recover(spark, path, discard=True)
    target = _stored(spark, path, batch, partition_by)
    if target is not None:
        if not key_index.has_index(spark, path):
            key_index.add_segment(target, path, keys, partition_by)
        narrowed = may_hold(spark, path, batch, keys, partition_by)
        broken = [] if narrowed is None else insert_conflicts(narrowed, batch, keys).limit(5).collect()
        if broken:
            raise ValueError(f"Duplicate keys, for instance {[row.asDict() for row in broken]}")
    key_index.add_segment(batch, path, keys, partition_by)
    publish(spark, path, batch, partition_by=partition_by)
    if target is None:
        keep_schema(spark, path, batch.schema)


def append(df: DataFrame, path: str) -> None:
    """Append a frame to a table without a key. An empty frame is an error, and so is a table with a key index."""
    if df.isEmpty():
        raise ValueError("The DataFrame is empty.")
    if key_index.has_index(df.sparkSession, path):
        raise ValueError("The table has a key index; use strict_insert or upsert_into.")
    df.write.mode("append").parquet(path)


def lookup(table: DataFrame, wanted: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Values of the wanted keys, NULL where the table has none."""
    return wanted.join(table.select(*keys, *values), list(keys), "left")


def retained(df: DataFrame, column: str, cutoff) -> DataFrame:
    """Rows from the cutoff on."""
    return df.where(F.col(column) >= cutoff)


def retention_report(df: DataFrame, column: str, cutoff) -> DataFrame:
    """Number of rows a retention delete would remove and keep."""
    return df.agg(
        F.count_if(F.col(column) < cutoff).alias("rows_to_delete"),
        F.count_if(F.col(column) >= cutoff).alias("rows_to_keep"),
    )


def delete_below(spark: SparkSession, path: str, column: str, cutoff, partition_by: Sequence[str] | None = None) -> int:
    """Delete the rows below the cutoff from a table on its own path and return how many there were.

    Files whose rows are all below are dropped, files without such a row are not touched, and only the kept rows of
    mixed files are written anew before those files go. Rows with NULL in the column are kept. Partition columns are
    those of the folders unless they are given; their values are carried as the texts that stand there.
    """
    recover(spark, path, discard=True)
    found = kept_schema(spark, path) or spark.read.parquet(path).schema
    below = F.coalesce(F.col(column) < cutoff, F.lit(False))
    listed = spark.read.schema(found).parquet(path).select(below.alias("_below"), F.col("_metadata.file_path").alias("_file"))
    counts = listed.groupBy("_file").agg(F.count_if("_below").alias("gone"), F.count(F.lit(1)).alias("n"))
    files = counts.where("gone > 0").collect()  # one row per file, as in the listing of the table itself
    if not files:
        return 0
    names = {row["_file"]: file_name(spark, row["_file"]) for row in files}
    mixed = [(row["_file"],) for row in files if row["gone"] < row["n"]]
    if partition_by is None:
        folders = place_in(spark, path, next(iter(names.values()))).split("/")[:-1]
        partition_by = [unquote(folder.split("=", 1)[0]) for folder in folders]
    rows = None
    if mixed:
        # The files of one value of a partition column are below the cutoff as a whole, so that column is a text here too.
        texts = T.StructType([T.StructField(f.name, T.StringType()) if f.name in partition_by else f for f in found.fields])
        kept = spark.read.schema(texts).parquet(path).withColumn("_file", F.col("_metadata.file_path")).where(~below)
        rows = kept.join(spark.createDataFrame(mixed, "_file string"), "_file", "left_semi").drop("_file")
    publish(spark, path, rows, list(names.values()), partition_by)
    return sum(row["gone"] for row in files)


def latest(df: DataFrame, column: str) -> DataFrame:
    """The highest value of a column as one row; NULL for an empty table."""
    return df.agg(F.max(column).alias(column))
