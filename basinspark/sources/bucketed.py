"""Keyed tables whose files are bucketed by key: lookups and upserts join them where they lie.

Every bucket is one sorted file, and Spark reads it as one partition of a hash partitioning, so a join on the key moves the
other side only. A table has a home folder with one folder per version, and its location in the catalog names the current
one. An upsert writes a whole new version and then changes the location, which is the one step that readers see; versions
that a lost writer left behind go with the next upsert.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinspark.session import delete_paths, persisted
from basinspark.sources.publish import _store
from basinspark.sources.tables import duplicate_keys, latest_by_key


def _write(rows: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> None:
    rows.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)


def create_bucketed(rows: DataFrame, name: str, home: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """A new table ``name`` below the folder ``home``; a repeated key is an error."""
    broken = duplicate_keys(rows, keys).limit(5).collect()
    if broken:
        raise ValueError(f"Duplicate keys, for instance {[row.asDict() for row in broken]}")
    _write(rows.repartition(buckets, *keys), name, f"{home}/{uuid.uuid4().hex}", keys, buckets)
    return rows.sparkSession.table(name)


def _details(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}


def upsert_bucketed(spark: SparkSession, name: str, batch: DataFrame, keys: Sequence[str], sequence: str | None = None) -> DataFrame:
    """Put the rows of a batch in place of those with the same key, in a new version with the same buckets.

    The stored rows are not shuffled: each task joins one bucket with its share of the batch and writes it again.
    """
    if sequence is not None:
        batch = latest_by_key(batch, keys, sequence).drop(sequence)
    batch = persisted(batch)
    broken = duplicate_keys(batch, keys).limit(5).collect()
    if broken:
        raise ValueError(f"Duplicate keys in the batch, for instance {[row.asDict() for row in broken]}")
    table, about = spark.table(name), _details(spark, name)
    current = about["Location"]
    home = current.rsplit("/", 1)[0]
    others = [c for c in table.columns if c not in keys]
    new = batch.select(*keys, F.struct(*[F.col(f"`{c}`") for c in others]).alias("_new"), F.lit(True).alias("_changed"))
    old = table.select(*keys, F.struct(*[F.col(f"`{c}`") for c in others]).alias("_old"))
    row = F.when(F.col("_changed"), F.col("_new")).otherwise(F.col("_old"))
    joined = old.join(new, list(keys), "full_outer").select(*keys, row.alias("_row"))
    rows = joined.select(*[F.col(f"`{c}`") if c in keys else F.col("_row").getField(c).alias(c) for c in table.columns])
    path, staged = f"{home}/{uuid.uuid4().hex}", f"staged_{uuid.uuid4().hex}"
    _write(rows, staged, path, keys, int(about["Num Buckets"]))
    spark.sql(f"DROP TABLE {staged}")  # the entry only; the files stay, as the table has a path of its own
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)
    root, store = _store(spark, home)
    left = [s.getPath().toString() for s in store.listStatus(root) if s.getPath().getName() != path.rsplit("/", 1)[1]]
    delete_paths(spark, left)
    return spark.table(name)
