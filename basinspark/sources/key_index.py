"""Bitmaps of the keys in each partition of a table, so that a strict insert reads only where a key can be.

The index lies in ``_keys`` below the table. Each lot of inserted rows adds a segment: per partition, the hashes of its keys
as bits, 16 to a key, in bitmaps of 32,768 bits each. A key that is stored always has its bit; one that is not has it by
chance in at most one of 16 cases. Bits are written before the rows they stand for, and stay when rows are deleted, so a
writer that is lost in between leaves at worst a partition to be read in vain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basinspark.session import broadcast_if_small, persisted
from basinspark.sources.publish import exists

FOLDER = "_keys"
BITS_PER_KEY = 16
#: Bits of one bitmap, as Spark's bitmap functions have them.
BITMAP = 32768


def partition_name(partition_by: Sequence[str]) -> Column:
    """The partition of a row as one text."""
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in partition_by])) if partition_by else F.lit("{}")


def key_hash(keys: Sequence[str]) -> Column:
    """Hash of a key, the same for every type that holds its values."""
    return F.xxhash64(*[F.col(k).cast("string") for k in keys])


def _place(size: Column) -> Column:
    """The bit of a hash in a space of ``size`` bits, counted from 1."""
    return F.pmod(F.col("_hash"), size) + 1


def segment(rows: DataFrame, keys: Sequence[str], partition_by: Sequence[str]) -> DataFrame:
    """Bitmaps of the keys of some rows, by partition."""
    hashed = rows.select(partition_name(partition_by).alias("partition"), key_hash(keys).alias("_hash"))
    wanted = F.log2(F.greatest(F.count("*") * BITS_PER_KEY, F.lit(BITMAP)))
    sizes = persisted(hashed.groupBy("partition").agg(F.pow(F.lit(2.0), F.ceil(wanted)).cast("long").alias("size")))
    placed = hashed.join(broadcast_if_small(sizes), "partition").withColumn("_place", _place(F.col("size")))
    return placed.groupBy("partition", "size", F.bitmap_bucket_number("_place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("bits")
    )


def add_segment(rows: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str]) -> None:
    segment(rows, keys, partition_by).write.mode("append").parquet(f"{path}/{FOLDER}")


def has_index(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/{FOLDER}")


def _has_bit(bits: Column, position: Column) -> Column:
    """Whether a bitmap has the bit at a position."""
    byte = F.conv(F.hex(bits.substr((F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    return F.floor(byte / F.pow(F.lit(2), position % 8)) % 2 == 1


def candidates(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], partition_by: Sequence[str]) -> list[str]:
    """Names of the partitions that may hold a key of the batch; no other partition does.

    Where the partition is part of the key, a key is looked up in its own partition only. As many names as there are
    partitions reach the driver at most.
    """
    index = spark.read.parquet(f"{path}/{FOLDER}")
    sizes = [r["size"] for r in index.select("size").distinct().collect()]  # powers of two, so a few dozen at most
    tied = bool(partition_by) and set(partition_by) <= set(keys)
    hashed = batch.select(partition_name(partition_by).alias("_partition"), key_hash(keys).alias("_hash"))
    probes = hashed.withColumn("_size", F.explode(F.array(*[F.lit(s).cast("long") for s in sizes]))) if sizes else hashed.limit(0).withColumn("_size", F.lit(0).cast("long"))
    probes = probes.withColumn("_place", _place(F.col("_size")))
    probes = probes.select("_partition", "_size", F.bitmap_bucket_number("_place").alias("_bucket"), F.bitmap_bit_position("_place").alias("_position"))
    same = (F.col("size") == F.col("_size")) & (F.col("bucket") == F.col("_bucket"))
    if tied:
        same &= F.col("partition") == F.col("_partition")
    hits = index.join(probes.distinct(), same).where(_has_bit(F.col("bits"), F.col("_position")))
    return [r["partition"] for r in hits.select("partition").distinct().collect()]
