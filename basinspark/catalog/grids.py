"""Queries on grids: crop, regrid, zonal reduction and incremental ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinspark.catalog import query
from basinspark.catalog.inputs import LINE_CENTS, LINE_MONTH, event_runs, line_months, table
from basinspark.functions.calendar import days_in_month
from basinspark.functions.hydro import cell_area
from basinspark.functions.numbers import mean
from basinspark.operators import grid
from basinspark.plans.reduction import run_table_from_grid
from basinspark.session import fresh_folder
from basinspark.sources.tables import read_table
from basinspark.streaming.completeness import followed_runs
from basinspark.streaming.ingest import ingest_fields, ingest_runs, stored_means, stored_run_table

STEP = 0.25
ZONES = ["eri_lake", "eri_land", "ont_lake", "ont_land", "sup_lake", "sup_land", "mih_lake", "mih_land"]

_CELLS = "CAST(l_quantity AS INTEGER) AS lat_i, l_linenumber AS lon_i"
# Two zones for some cells, none for others; weights are NULL, 0 or a fraction.
_MASK = f"""
    SELECT lat_i, lon_i, {ZONES}[k + 1] AS zone,
           CASE WHEN lat_i % 11 = 0 THEN NULL ELSE ((lat_i + 2 * lon_i) % 4) / 4.0::DOUBLE END AS weight
    FROM (
        SELECT lat_i, lon_i, (lat_i * 3 + lon_i) % 8 AS k FROM cells
        UNION ALL SELECT lat_i, lon_i, (lat_i * 3 + lon_i + 1) % 8 FROM cells WHERE lat_i % 5 = 0
    )
"""
_AREA = "6371000.0::DOUBLE * 6371000.0::DOUBLE * radians(0.25) * radians(0.25) * cos(radians(41 + 0.25::DOUBLE * lat_i))"
_DAYS = "day(last_day(make_date(year, month, 1)))"


def _fields(spark: SparkSession, folder: str) -> DataFrame:
    """Every line item as one grid cell value of its month and line status."""
    return line_months(spark, folder).select(
        "year",
        "month",
        F.col("l_linestatus").alias("variable"),
        F.col("l_quantity").cast("int").alias("lat_i"),
        F.col("l_linenumber").alias("lon_i"),
        F.when(F.col("l_discount") != 0.05, F.col("cents").cast("double")).alias("value"),
    )


_FIELDS = f"""
    SELECT {LINE_MONTH}, l_linestatus AS variable, {_CELLS},
           CASE WHEN l_discount <> 0.05::DOUBLE THEN CAST({LINE_CENTS} AS DOUBLE) END AS value
    FROM lineitem
"""


def _mask(spark: SparkSession, folder: str) -> DataFrame:
    cells = table(spark, folder, "lineitem").select(
        F.col("l_quantity").cast("int").alias("lat_i"), F.col("l_linenumber").alias("lon_i")
    ).distinct()
    k = (F.col("lat_i") * 3 + F.col("lon_i")) % 8
    again = ((F.col("lat_i") * 3 + F.col("lon_i") + 1) % 8).cast("int")
    zones = F.array(*[F.lit(zone) for zone in ZONES])
    numbers = F.when(F.col("lat_i") % 5 == 0, F.array(k, again)).otherwise(F.array(k))
    return cells.select("lat_i", "lon_i", F.explode(numbers).alias("k")).select(
        "lat_i",
        "lon_i",
        F.get(zones, F.col("k")).alias("zone"),
        F.when(F.col("lat_i") % 11 != 0, ((F.col("lat_i") + 2 * F.col("lon_i")) % 4) / F.lit(4.0)).alias("weight"),
    )


def _area():
    return cell_area(F.lit(41) + F.lit(STEP) * F.col("lat_i"), STEP, -STEP)


@query(
    """
    SELECT lat, lon, count(*) AS n_cells FROM (SELECT l_quantity AS lat, CAST(l_linenumber AS DOUBLE) AS lon FROM lineitem)
    WHERE lat BETWEEN (SELECT min(n_nationkey) - 1 FROM nation) AND (SELECT max(n_nationkey) + 1 FROM nation)
      AND lon BETWEEN (SELECT min(n_regionkey) - 1 FROM nation) AND (SELECT max(n_regionkey) + 1 FROM nation)
    GROUP BY ALL
    """
)
def bbox_crop(spark: SparkSession, folder: str) -> DataFrame:
    cells = table(spark, folder, "lineitem").select(
        F.col("l_quantity").alias("lat"), F.col("l_linenumber").cast("double").alias("lon")
    )
    extent = table(spark, folder, "nation").select(
        F.col("n_nationkey").cast("double").alias("lat"), F.col("n_regionkey").cast("double").alias("lon")
    )
    cropped = grid.crop(cells, extent, pad_lat=1.0, pad_lon=1.0)
    return cropped.groupBy("lat", "lon").agg(F.count(F.lit(1)).alias("n_cells"))


_WEIGHTED_SQL = f"""
    WITH cells AS (SELECT DISTINCT {_CELLS} FROM lineitem), mask AS ({_MASK}), fields AS ({_FIELDS})
    SELECT year, month, variable, zone,
           round(sum(value * weight * {_AREA}) * (4 * {_DAYS} / 1e5)
                 / sum(weight * {_AREA}) FILTER (value IS NOT NULL), 6) AS value
    FROM fields JOIN mask USING (lat_i, lon_i) WHERE weight <> 0
    GROUP BY year, month, variable, zone
"""


@query(_WEIGHTED_SQL)
def zonal_weighted_mean(spark: SparkSession, folder: str) -> DataFrame:
    cells = grid.in_zone(_fields(spark, folder), grid.prepare_mask(_mask(spark, folder)))
    means = grid.zonal_mean(
        cells, ["year", "month", "variable", "zone"], area=_area(), factor=4.0 * days_in_month("year", "month") / 1e5
    )
    return means.withColumn("value", F.round("value", 6))


@query(
    f"""
    WITH cells AS (SELECT DISTINCT {_CELLS} FROM lineitem),
    mask AS (SELECT lat_i, lon_i, zone, coalesce(weight, 'NaN'::DOUBLE) AS weight FROM ({_MASK})),
    fields AS (SELECT * REPLACE (coalesce(value, 'NaN'::DOUBLE) AS value) FROM ({_FIELDS}))
    SELECT year, month, variable, zone,
           round(sum(value * weight * {_AREA}) * (4 * {_DAYS} / 1e5) / sum(weight * {_AREA}), 6) AS value
    FROM fields JOIN mask USING (lat_i, lon_i) WHERE weight <> 0 AND NOT isnan(weight) AND NOT isnan(value)
    GROUP BY year, month, variable, zone
    """
)
def zonal_nan_cells(spark: SparkSession, folder: str) -> DataFrame:
    """NaN in place of NULL in fields and mask; zones without any value are left out."""
    nan = F.lit(float("nan"))
    fields = _fields(spark, folder).withColumn("value", F.coalesce("value", nan))
    mask = grid.prepare_mask(_mask(spark, folder).withColumn("weight", F.coalesce("weight", nan)))
    keys = ["year", "month", "variable", "zone"]
    means = grid.zonal_mean(grid.in_zone(fields, mask), keys, area=_area(), factor=4.0 * days_in_month("year", "month") / 1e5)
    return means.where("value IS NOT NULL").withColumn("value", F.round("value", 6))


@query(
    f"""
    WITH cells AS (SELECT DISTINCT {_CELLS} FROM lineitem), mask AS ({_MASK}), fields AS ({_FIELDS})
    SELECT year, month, variable, zone, avg(value) AS value
    FROM fields JOIN mask USING (lat_i, lon_i) WHERE weight <> 0 GROUP BY ALL
    """
)
def zonal_plain_mean(spark: SparkSession, folder: str) -> DataFrame:
    cells = grid.in_zone(_fields(spark, folder), grid.prepare_mask(_mask(spark, folder)))
    return grid.zonal_plain_mean(cells, ["year", "month", "variable", "zone"])


_REGRID_SQL = f"""
    WITH source AS (
        SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(l_quantity AS INTEGER) - 1 AS lat_i,
               l_linenumber - 1 AS lon_i, CAST(sum({LINE_CENTS}) AS DOUBLE) / count(*) AS value
        FROM lineitem WHERE NOT (l_quantity = 25 AND l_linenumber = 3) GROUP BY ALL
    ), points AS (
        SELECT p_partkey, (p_partkey % 101) / 2.0::DOUBLE AS y, (p_partkey % 14) / 2.0::DOUBLE AS x FROM part
    ), inside AS (SELECT *, floor(y) AS i, floor(x) AS j FROM points WHERE y <= 49 AND x <= 6),
    corners AS (
        SELECT p_partkey, i + di AS lat_i, j + dj AS lon_i,
               (CASE di WHEN 1 THEN y - i ELSE 1 - (y - i) END) * (CASE dj WHEN 1 THEN x - j ELSE 1 - (x - j) END) AS w
        FROM inside, (SELECT unnest([0, 0, 1, 1]) AS di, unnest([0, 1, 0, 1]) AS dj)
    ), weights AS (SELECT *, count(*) OVER (PARTITION BY p_partkey) AS needed FROM corners WHERE w > 0)
    SELECT year, p_partkey, CASE WHEN count(*) = max(needed) THEN round(sum(w * value), 4) END AS value
    FROM source JOIN weights USING (lat_i, lon_i) GROUP BY ALL
    """


def _part_points(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Cell means per year and the weights of one point per part."""
    source = (
        line_months(spark, folder)
        .where("NOT (l_quantity = 25 AND l_linenumber = 3)")
        .groupBy(
            "year",
            (F.col("l_quantity").cast("int") - 1).alias("lat_i"),
            (F.col("l_linenumber") - 1).alias("lon_i"),
        )
        .agg(mean("cents").alias("value"))
    )
    points = table(spark, folder, "part").select(
        "p_partkey",
        (F.col("p_partkey") % 101 / 2.0 + 1).alias("lat"),
        (F.col("p_partkey") % 14 / 2.0 + 1).alias("lon"),
    )
    weights = grid.bilinear_weights(points, 1.0, 1.0, 50, 1.0, 1.0, 7, target=["p_partkey"])
    return source, weights


@query(_REGRID_SQL)
def regrid_bilinear(spark: SparkSession, folder: str) -> DataFrame:
    """Cell means per year interpolated to one point per part; points off the grid have no value."""
    source, weights = _part_points(spark, folder)
    return grid.regrid(source, weights, ["year"], target=["p_partkey"]).withColumn("value", F.round("value", 4))


@query(_REGRID_SQL)
def regrid_repeated_cells(spark: SparkSession, folder: str) -> DataFrame:
    """As regrid_bilinear, with every cell twice, one above and one below its value, and once without a value."""
    source, weights = _part_points(spark, folder)
    shifts = F.array(F.lit(-50.0), F.lit(50.0), F.lit(None), F.lit(float("nan")))
    again = source.select("year", "lat_i", "lon_i", F.explode(shifts).alias("shift"), (F.col("value") + F.col("shift")).alias("value"))
    return grid.regrid(again, weights, ["year"], target=["p_partkey"]).withColumn("value", F.round("value", 4))


_RUN_TABLE_SQL = f"""
    WITH means AS (
        SELECT CAST(year(l_shipdate) AS INTEGER) AS year,
               CASE l_returnflag WHEN 'A' THEN 'p' WHEN 'N' THEN 't' ELSE 'le' END AS variable,
               CASE WHEN l_returnflag <> 'A' AND l_linestatus = 'O' THEN 1 ELSE 0 END AS second, l_returnflag,
               CAST(l_quantity AS INTEGER) - 1 AS src_lat_i, l_linenumber - 1 AS src_lon_i,
               CAST(sum({LINE_CENTS}) AS DOUBLE) / count(*) / 1e5 AS mean
        FROM lineitem GROUP BY ALL
    ), raw AS (
        SELECT year, variable, second, src_lat_i, src_lon_i,
               mean + CASE l_returnflag WHEN 'N' THEN 250 ELSE 0 END AS value
        FROM means
    ), targets AS (
        SELECT CAST(l_quantity AS INTEGER) - 1 AS lat_i, l_linenumber - 1 AS lon_i FROM lineitem
        WHERE l_quantity < 50 AND l_linenumber < 7 GROUP BY ALL
    ), corners AS (
        SELECT lat_i, lon_i, lat_i + di AS src_lat_i, lon_i + dj AS src_lon_i, 0.25::DOUBLE AS w
        FROM targets, (SELECT unnest([0, 0, 1, 1]) AS di, unnest([0, 1, 0, 1]) AS dj)
    ), fields AS (
        SELECT year, variable, second, lat_i, lon_i, CASE WHEN count(*) = 4 THEN sum(w * value) END AS value
        FROM raw JOIN corners USING (src_lat_i, src_lon_i) GROUP BY ALL
    ), wide AS (
        SELECT year, lat_i, lon_i, max(value) FILTER (variable = 'p') AS p,
               coalesce(max(value) FILTER (variable = 't' AND second = 0), max(value) FILTER (variable = 't' AND second = 1)) AS t,
               coalesce(max(value) FILTER (variable = 'le' AND second = 0), max(value) FILTER (variable = 'le' AND second = 1)) AS le
        FROM fields GROUP BY ALL
    ), long AS (
        SELECT year, lat_i, lon_i, 'precipitation' AS component, p AS value FROM wide
        UNION ALL SELECT year, lat_i, lon_i, 'air_temperature', t FROM wide
        UNION ALL SELECT year, lat_i, lon_i, 'evaporation', le * 1e-6 / (2.501 - 0.002361 * (t - 273.15)) FROM wide
    ), zoned AS (
        SELECT year, component, value, {ZONES}[(lat_i + lon_i) % 8 + 1] AS zone, ((lat_i + 2 * lon_i) % 4) / 4.0::DOUBLE AS weight,
               cos(radians(41 + 0.25::DOUBLE * lat_i)) AS area,
               day(last_day(make_date(year, 7, 1))) AS days
        FROM long WHERE value IS NOT NULL
    )
    SELECT CAST(CAST(year AS BIGINT) * 1000000 + 70100 AS BIGINT) AS cfs_run, year, CAST(7 AS INTEGER) AS month,
           CASE left(zone, 3) WHEN 'eri' THEN 'erie' WHEN 'ont' THEN 'ontario' WHEN 'sup' THEN 'superior'
                ELSE 'michigan-huron' END AS lake, substring(zone, 5) AS surface_type, component,
           round(CASE component WHEN 'air_temperature' THEN avg(value)
                WHEN 'precipitation' THEN sum(value * weight * area) * 4 * days / sum(weight * area)
                ELSE sum(value * weight * area) * 86400 * days / sum(weight * area) END, 6) AS "value [mm]"
    FROM zoned WHERE weight <> 0 GROUP BY year, zone, component, days
    """


def _reduction_inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fields with alternative variable names, interpolation weights and a mask."""
    names = {"AF": "tp", "AO": "tp", "NF": "avg_2t", "NO": "mean2t", "RF": "avg_slhtf", "RO": "mslhf"}
    codes = F.create_map(*[F.lit(part) for pair in names.items() for part in pair])
    cell = [(F.col("l_quantity").cast("int") - 1).alias("lat_i"), (F.col("l_linenumber") - 1).alias("lon_i")]
    fields = (
        line_months(spark, folder)
        .groupBy(
            (F.col("year").cast("long") * 1000000 + 70100).alias("run"),
            "year",
            F.lit(7).alias("month"),
            codes[F.concat("l_returnflag", "l_linestatus")].alias("variable"),
            *cell,
        )
        .agg((mean("cents") / 1e5).alias("value"))
        .withColumn("value", F.col("value") + F.when(F.col("variable").isin("avg_2t", "mean2t"), 250).otherwise(0))
    )
    targets = (
        table(spark, folder, "lineitem").where("l_quantity < 50 AND l_linenumber < 7").select(*cell).distinct()
    )
    weights = grid.bilinear_weights(
        targets.withColumns({"lat": F.col("lat_i") + 0.5, "lon": F.col("lon_i") + 0.5}), 0.0, 1.0, 50, 0.0, 1.0, 7
    )
    mask = targets.select(
        "lat_i",
        "lon_i",
        (F.lit(41) + F.lit(STEP) * F.col("lat_i")).alias("lat"),
        F.get(F.array(*[F.lit(z) for z in ZONES]), (F.col("lat_i") + F.col("lon_i")) % 8).alias("zone"),
        ((F.col("lat_i") + 2 * F.col("lon_i")) % 4 / F.lit(4.0)).alias("weight"),
    )
    return fields, weights, mask


def _run_table(fields: DataFrame, weights: DataFrame, mask: DataFrame) -> DataFrame:
    rows = run_table_from_grid(fields, weights, mask, STEP, STEP)
    return rows.withColumn("value [mm]", F.round("value [mm]", 6))


@query(_RUN_TABLE_SQL)
def grid_to_run_table(spark: SparkSession, folder: str) -> DataFrame:
    """The whole reduction: alternative variable names, regrid, evaporation, zones and monthly amounts."""
    return _run_table(*_reduction_inputs(spark, folder))


@query(_RUN_TABLE_SQL)
def grid_two_levels(spark: SparkSession, folder: str) -> DataFrame:
    """As grid_to_run_table, from fields that also hold other levels of every variable."""
    fields, weights, mask = _reduction_inputs(spark, folder)
    warm = F.col("variable").isin("avg_2t", "mean2t")
    right = fields.withColumns(
        {"level_type": F.when(warm, "heightAboveGround").otherwise("surface"), "level": F.when(warm, 2).otherwise(0)}
    )
    wrong = fields.withColumns({"level_type": F.lit("isobaricInhPa"), "level": F.lit(850), "value": F.col("value") + 999})
    return _run_table(right.unionByName(wrong), weights, mask)


@query(_RUN_TABLE_SQL)
def incremental_run_table(spark: SparkSession, folder: str) -> DataFrame:
    """The whole reduction of files that arrive in two lots; a restart without its progress repeats all of them."""
    fields, weights, mask = _reduction_inputs(spark, folder)
    arrivals, target = fresh_folder(spark, "arrivals"), fresh_folder(spark, "sums")

    def ingest(checkpoint: str) -> None:
        ingest_fields(spark, arrivals, fields.schema, weights, mask, target, checkpoint, STEP, STEP, files_per_batch=4)

    first = fresh_folder(spark, "progress")
    for lot in (fields.where("year < 1999"), fields.where("year >= 1999")):
        lot.repartition("run", "year", "month").write.mode("append").parquet(arrivals)  # a run and month in one file
        ingest(first)
    ingest(fresh_folder(spark, "progress"))
    return stored_run_table(read_table(spark, target)).withColumn("value [mm]", F.round("value [mm]", 6))


@query(
    f"""
    WITH stored AS (
        SELECT DISTINCT CAST(year(ts) * 1000000 + month(ts) * 10000 + day(ts) * 100 AS BIGINT) AS cfs_run,
               CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, event_type AS component,
               CASE user_id % 3 WHEN 0 THEN 'erie' WHEN 1 THEN 'ontario' ELSE 'superior' END AS lake
        FROM events
    ), wanted AS (
        SELECT DISTINCT cfs_run, year, month, c AS component, l AS lake
        FROM stored, (SELECT unnest(['view', 'click']) AS c), (SELECT unnest(['erie', 'ontario', 'superior', 'michigan-huron']) AS l)
    )
    SELECT cfs_run, year, month, lake, 'lake' AS surface_type, component FROM wanted
    ANTI JOIN stored USING (cfs_run, year, month, component, lake)
    """
)
def incomplete_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Combinations that each run should have and has not."""
    lakes = F.array(F.lit("erie"), F.lit("ontario"), F.lit("superior"))
    rows = table(spark, folder, "events").select(
        (F.year("ts").cast("long") * 1000000 + F.month("ts") * 10000 + F.dayofmonth("ts") * 100).alias("cfs_run"),
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.get(lakes, (F.col("user_id") % 3).cast("int")).alias("lake"),
        F.lit("lake").alias("surface_type"),
        F.col("event_type").alias("component"),
    )
    zones = [(lake, "lake") for lake in ("erie", "ontario", "superior", "michigan-huron")]
    return grid.expected_combinations(rows, ["view", "click"], zones)


@query(_WEIGHTED_SQL)
def incremental_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """The zonal means from files that arrive in two lots; the second stream restart repeats all of them."""
    arrivals, target = fresh_folder(spark, "arrivals"), fresh_folder(spark, "sums")
    fields = _fields(spark, folder)
    keys = ["year", "month", "variable", "zone"]
    late = F.col("year") >= 1999

    def arrive(lot: DataFrame) -> None:
        lot.repartition(4, "year", "month").write.mode("append").parquet(arrivals)

    def ingest(checkpoint: str) -> None:
        ingest_runs(
            spark,
            arrivals,
            fields.schema,
            _mask(spark, folder),
            target,
            checkpoint,
            keys=keys,
            partition_by=["year"],
            area=_area(),
            files_per_batch=4,
        )

    first = fresh_folder(spark, "progress")
    arrive(fields.where(~late))
    ingest(first)
    arrive(fields.where(late))
    ingest(first)
    ingest(fresh_folder(spark, "progress"))
    means = stored_means(read_table(spark, target), keys, factor=4.0 * days_in_month("year", "month") / 1e5)
    return means.withColumn("value", F.round("value", 6))


_RUN_VALUES = """
    SELECT time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '2000-01-01 00:00:00') AS run_ts, ascii(event_type) % 3 * 4 + user_id % 4 AS number
    FROM events WHERE NOT (user_id % 4 = 3 AND day(ts) % 3 = 0)
"""


@query(
    f"""
    WITH runs AS (SELECT run_ts, CAST(count(DISTINCT number) AS INTEGER) AS n FROM ({_RUN_VALUES}) GROUP BY run_ts),
    whole AS (SELECT count(DISTINCT ascii(event_type) % 3 * 4 + user_id % 4) AS expected FROM events),
    ends AS (SELECT max(run_ts) AS last FROM runs)
    SELECT CAST(strftime(run_ts, '%Y%m%d%H') AS BIGINT) AS run, CASE WHEN n = expected THEN 'complete' ELSE 'late' END AS status, n AS n_values
    FROM runs, whole, ends WHERE n = expected OR run_ts + INTERVAL 50 HOURS < last
    """
)
def run_completeness(spark: SparkSession, folder: str) -> DataFrame:
    """Runs that are complete or late, from files in three lots: the first half, the second with repeats, and one too late."""
    number = F.ascii("event_type") % 3 * 4 + F.col("user_id") % 4
    values = event_runs(spark, folder).select("run", F.to_timestamp(F.col("run").cast("string"), "yyyyMMddHH").alias("run_ts"), number.cast("int").alias("number"), "user_id")
    known = {r[0]: i for i, r in enumerate(values.select("number").distinct().orderBy("number").collect())}  # twelve at most
    places = F.create_map(*[F.lit(v) for pair in known.items() for v in pair])
    values = values.withColumn("number", places[F.col("number")])
    missing = (F.col("user_id") % 4 == 3) & (F.dayofmonth("run_ts") % 3 == 0)
    first, last = values.agg(F.min("run_ts"), F.max("run_ts")).first()
    half = F.lit((first + (last - first) / 2).replace(hour=0, minute=0, second=0, microsecond=0)).cast("timestamp")
    arrivals, reports, progress = (fresh_folder(spark, name) for name in ("values", "reports", "progress"))
    come = values.where(~missing)
    lots = [come.where(F.col("run_ts") < half), come.where(F.col("run_ts") >= half - F.expr("INTERVAL 2 DAYS")), values.where(missing & (F.col("run_ts") < half))]
    for lot in lots:
        lot.select("run", "run_ts", "number").write.mode("append").parquet(arrivals)
        stream = spark.readStream.schema("run long, run_ts timestamp, number int").parquet(arrivals)
        query = followed_runs(stream, len(known), "25 hours").writeStream.outputMode("append").option("checkpointLocation", progress).trigger(availableNow=True)
        query.format("parquet").option("path", reports).start().awaitTermination()
    return spark.read.parquet(reports)


@query(_WEIGHTED_SQL)
def ingest_same_names(spark: SparkSession, folder: str) -> DataFrame:
    """Two folders of files with the same names, each with a part of the cells of every key, in two lots."""
    arrivals, target, progress = fresh_folder(spark, "arrivals"), fresh_folder(spark, "sums"), fresh_folder(spark, "progress")
    fields, keys = _fields(spark, folder), ["year", "month", "variable", "zone"]
    for part in (0, 1):
        at = f"{arrivals}/lot{part}"
        fields.where(F.col("lon_i") % 2 == part).repartition(4).write.parquet(at)
        same_names(spark, at)
        ingest_runs(
            spark, f"{arrivals}/*", fields.schema, _mask(spark, folder), target, progress, keys=keys, partition_by=["year"], area=_area()
        )
    means = stored_means(read_table(spark, target), keys, factor=4.0 * days_in_month("year", "month") / 1e5)
    return means.withColumn("value", F.round("value", 6))


def same_names(spark: SparkSession, folder: str) -> None:
    """Name the files of a folder by their number alone."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(conf)
    for file in store.listStatus(path):
        name = file.getPath().getName()
        if name.startswith("part-"):
            store.rename(file.getPath(), jvm.org.apache.hadoop.fs.Path(path, name[:10] + ".parquet"))
