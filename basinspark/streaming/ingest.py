"""Ingest of arriving grid files: zonal sums per file are upserted, means are taken on read.

A micro-batch may hold only a part of the cells of a run, and a ratio cannot be updated piecewise. So sums are stored
for each source file, by its whole path, and key. Files are never divided between micro-batches, hence a repeated batch, or a stream that
is started again from nothing, puts the same sums in place of the old ones and nothing is counted twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basinspark.functions.hydro import cell_area
from basinspark.operators.grid import in_zone, prepare_mask, zonal_sums
from basinspark.plans.reduction import FIELD_KEYS, component_cells, run_table_rows
from basinspark.sources.tables import upsert_into

SUMS = ["weighted_sum", "weight_sum", "plain_sum", "n_cells"]


def ingest_runs(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    mask: DataFrame,
    target: str,
    checkpoint: str,
    keys: Sequence[str] = ("run", "year", "month", "variable", "zone"),
    partition_by: Sequence[str] = ("year", "month"),
    area: Column | str = "area",
    after_run: int | None = None,
    files_per_batch: int = 1000,
    cells: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Process the grid files that are new since the last call, and stop.

    ``after_run`` leaves out runs up to a stored one. ``cells`` turns the fields of a batch into cells of the mask with
    ``value`` and the key columns, file by file (``source_file`` is one of their keys).
    """
    arriving = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )
    if after_run is not None:
        arriving = arriving.where(F.col("run") > after_run)
    row_key = ["source_file", *keys]
    mask = prepare_mask(mask)

    def store(batch: DataFrame, _batch_id: int) -> None:
        reduced = batch if cells is None else cells(batch)
        upsert_into(
            batch.sparkSession, target, zonal_sums(in_zone(reduced, mask), row_key, area=area), row_key, partition_by
        )

    query = (
        arriving.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest_fields(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    weights: DataFrame,
    mask: DataFrame,
    target: str,
    checkpoint: str,
    step_latitude: float,
    step_longitude: float,
    after_run: int | None = None,
    files_per_batch: int = 1000,
) -> None:
    """The whole reduction of new files: levels, regridding, evaporation and zonal sums.

    A file must hold all fields of its run and month that evaporation needs, temperature and latent heat, and all
    neighbours of the target cells that it covers; the files of the forecast archive do.
    """
    keys = ["run", "year", "month", "component", "zone"]
    ingest_runs(
        spark, source, schema, mask, target, checkpoint, keys,
        area=cell_area("lat", step_latitude, step_longitude), after_run=after_run, files_per_batch=files_per_batch,
        cells=lambda batch: component_cells(batch, weights, ["source_file", *FIELD_KEYS]),
    )


def stored_run_table(sums: DataFrame) -> DataFrame:
    """Rows of the run table from the stored sums of all files."""
    total = sums.groupBy(*FIELD_KEYS, "component", "zone").agg(*[F.sum(name).alias(name) for name in SUMS])
    return run_table_rows(total)


def stored_means(
    sums: DataFrame, keys: Sequence[str], factor: Column | float = 1.0, weighted: bool = True, out: str = "value"
) -> DataFrame:
    """Zonal means from the stored sums of all files."""
    factor = F.lit(factor) if isinstance(factor, (int, float)) else factor
    top, bottom = ("weighted_sum", "weight_sum") if weighted else ("plain_sum", "n_cells")
    total = sums.groupBy(*keys).agg(F.sum(top).alias("_top"), F.sum(bottom).cast("double").alias("_bottom"))
    return total.select(*keys, F.try_divide(F.col("_top") * factor, F.col("_bottom")).alias(out))
