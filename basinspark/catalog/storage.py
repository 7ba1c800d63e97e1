"""Queries on sources, sinks and keyed tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basinspark.catalog import query
from basinspark.catalog.inputs import (
    EVENT_RUN,
    LINE_CENTS,
    LINE_MONTH,
    ORDER_CENTS,
    cents,
    event_runs,
    line_months,
    order_months,
    table,
)
from basinspark.functions.calendar import month_label, month_start
from basinspark.operators.ensemble import ensemble_mean
from basinspark.operators.shape import to_wide
from basinspark.operators.skill import format_observed
from basinspark.schemas import MONTH_NAMES
from basinspark.session import fresh_folder
from basinspark.sources import listings, tables
from basinspark.sources.bucketed import create_bucketed, upsert_bucketed
from basinspark.sources.delimited import read_series, write_tsv
from basinspark.sources.preamble import read_below
from basinspark.sources.grids import one_name, preferred_column, preferred_variable, select_fields


@query(
    f"""
    SELECT l_returnflag AS series, {LINE_MONTH}, strftime(l_shipdate, '%Y-%m') AS month_label,
           CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start,
           avg(l_quantity) AS mean_quantity, CAST(sum(CAST(l_linenumber AS BIGINT)) AS BIGINT) AS sum_linenumber
    FROM lineitem GROUP BY ALL
    """
)
def typed_monthly_series(spark: SparkSession, folder: str) -> DataFrame:
    lines = line_months(spark, folder).withColumns(
        {"year": F.col("year").cast("double"), "month": F.col("month").cast("double")}
    )
    grouped = lines.groupBy(F.col("l_returnflag").alias("series"), "year", "month").agg(
        F.avg("l_quantity").alias("mean_quantity"), F.sum("l_linenumber").alias("sum_linenumber")
    )
    return grouped.withColumns(
        {
            "year": F.col("year").cast("int"),
            "month": F.col("month").cast("int"),
            "month_label": month_label("year", "month"),
            "month_start": month_start("year", "month"),
        }
    )


@query(
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
           o_orderpriority
    FROM orders
    """
)
def tsv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    path = fresh_folder(spark, "orders-tsv")
    write_tsv(orders, path)
    return read_series(spark, path, orders.schema, sep="\t")


_OBSERVED_SQL = f"""
    SELECT l_returnflag AS lake, CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start,
           CAST(sum({LINE_CENTS}) AS DOUBLE) / count(*) AS observed
    FROM lineitem GROUP BY ALL
"""


def _observed_files(spark: SparkSession, folder: str, remark: str) -> tuple[str, T.StructType]:
    """Per-series year × month files below eleven lines of preamble; empty months are sentinels."""
    lines = line_months(spark, folder).withColumnRenamed("l_returnflag", "lake")
    wide = to_wide(
        lines.withColumn("name", F.date_format(month_start("year", "month"), "MMM")),
        ["lake", "year"],
        "name",
        MONTH_NAMES,
        "cents",
        fill=-99990.0,
    )
    rows = wide.select(
        "lake",
        (F.col("year") + 100).alias("line"),
        F.concat(F.concat_ws(",", "year", *MONTH_NAMES), F.lit(" \r")).alias("value"),
    )
    headings = wide.select("lake").distinct().select(
        "lake",
        F.explode(
            F.array(
                *[F.struct(F.lit(i).alias("line"), F.lit(f"{remark} {i}, with a comma ").alias("value")) for i in range(11)],
                F.struct(F.lit(11).alias("line"), F.lit("Year, " + ", ".join(MONTH_NAMES) + " \r").alias("value")),
            )
        ).alias("h"),
    )
    path = fresh_folder(spark, "observed-csv")
    # A file has one line per year, so the calendar bounds the rows of a lake.
    (
        rows.unionByName(headings.select("lake", "h.*"))
        .repartition("lake")
        .sortWithinPartitions("lake", "line")
        .select("lake", "value")
        .write.partitionBy("lake")
        .text(path)
    )
    schema = ", ".join(["Year int", *[f"{name} double" for name in MONTH_NAMES]])
    return path, spark.createDataFrame([], schema).schema


@query(_OBSERVED_SQL)
def preamble_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Per-series year × month files with a comment preamble, read back and unpivoted; empty months are sentinels."""
    path, schema = _observed_files(spark, folder, "# remark")
    files = read_series(spark, [f"{path}/lake=*"], schema, comment="#").withColumn(
        "lake", F.regexp_extract(F.col("_metadata.file_path"), "lake=([^/]*)/", 1)
    )
    return format_observed(files, ids=["lake"])


@query(_OBSERVED_SQL)
def preamble_by_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The same files with a preamble that no character marks, left out by its number of lines."""
    path, schema = _observed_files(spark, folder, "remark, 1999, 7,")
    return format_observed(read_below(spark, [f"{path}/lake=*"], schema, 11, name_pattern="lake=([^/]*)/", name_columns=("lake",)), ids=["lake"])


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def append_twice(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = fresh_folder(spark, "appended")
    tables.append(orders.where("o_orderstatus = 'F'"), path)
    tables.append(orders.where("o_orderstatus <> 'F'"), path)
    return tables.read_table(spark, path, orders.schema)


@query(
    f"""
    SELECT event_type || '.01.' || {EVENT_RUN} || '.avrg.grib.grb2' AS name, count(*) AS n_fields
    FROM events WHERE event_type = 'click' AND strftime(ts, '%Y%m') = '202401' GROUP BY ALL
    """
)
def run_file_scan(spark: SparkSession, folder: str) -> DataFrame:
    named = event_runs(spark, folder).select(
        F.concat("event_type", F.lit(".01."), "run", F.lit(".avrg.grib.grb2")).alias("name")
    )
    manifest = named.groupBy("name").agg(F.count(F.lit(1)).alias("n_fields"))
    return listings.select_run_files(manifest, "name", "click.01.", "202401", "grb2")


@query(
    f"""
    SELECT {EVENT_RUN} AS run, event_type AS variable, event_id, value
    FROM events WHERE event_type IN ('view', 'purchase') AND user_id % 3 = 2
    """
)
def level_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Two variables at one level; the level is a property of each event."""
    fields = event_runs(spark, folder).select(
        "run",
        F.col("event_type").alias("variable"),
        F.lit("heightAboveGround").alias("level_type"),
        (F.col("user_id") % 3).cast("int").alias("level"),
        "event_id",
        "value",
    )
    chosen = select_fields(fields, ["view", "purchase"], level_type="heightAboveGround", level=2)
    return chosen.select("run", "variable", "event_id", "value")


@query(
    r"""
    SELECT page_id, href, url || href AS file_url, string_split(href, '/')[-1] AS file_name
    FROM (
        SELECT page_id, url, unnest(regexp_extract_all(
            regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g'),
            '(?i)<a\s+href="([^"]*)"', 1)) AS href
        FROM pages
    )
    WHERE starts_with(href, '/')
    """
)
def link_harvest(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return listings.harvest_links(pages, "html", F.col("url"), "/", "").select(
        "page_id", "href", "file_url", "file_name"
    )


@query(
    """
    SELECT page_id, 'prefix' AS affix FROM pages WHERE starts_with(url, 'https://www')
    UNION ALL SELECT page_id, 'suffix' FROM pages WHERE ends_with(url, '.html')
    """
)
def manifest_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    wanted = [("prefix", "https://www"), ("suffix", ".html"), ("infix", "example")]
    found = [
        listings.filter_names(pages, "url", affix, text).select("page_id", F.lit(affix).alias("affix"))
        for affix, text in wanted
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query(
    """
    SELECT page_id, CASE WHEN starts_with(url, 'https://') THEN substring(url, 9) ELSE url END AS path
    FROM pages WHERE contains(url, 'blog') AND ends_with(url, '/')
    """
)
def relative_keys(spark: SparkSession, folder: str) -> DataFrame:
    return listings.filter_keys(table(spark, folder, "pages"), "url", "blog", "/", "https://").select("page_id", "path")


@query(
    f"""
    SELECT event_id, strftime(ts + to_months(CAST(event_id % 10 AS INTEGER)), '%Y%m') AS forecast,
           CAST(year(ts + to_months(CAST(event_id % 10 AS INTEGER))) AS INTEGER) AS forecast_year,
           CAST(month(ts + to_months(CAST(event_id % 10 AS INTEGER))) AS INTEGER) AS forecast_month
    FROM events
    """
)
def name_fields(spark: SparkSession, folder: str) -> DataFrame:
    valid = F.add_months(F.col("ts").cast("date"), (F.col("event_id") % 10).cast("int"))
    period = F.format_string("%04d%02d", F.year(valid), F.month(valid))
    named = event_runs(spark, folder).select(
        "event_id", F.concat_ws(".", "event_type", F.lit("01"), "run", period, F.lit("avrg.grib.grb2")).alias("name")
    )
    return listings.name_fields(named, "name").drop("name")


@query(
    f"""
    SELECT run, coalesce(max(value) FILTER (event_type = 'view'), max(value) FILTER (event_type = 'click')) AS value,
           'seen' AS variable
    FROM (SELECT {EVENT_RUN} * 100 + user_id AS run, event_type, value FROM events)
    WHERE event_type IN ('view', 'click') GROUP BY run
    """
)
def variable_fallback(spark: SparkSession, folder: str) -> DataFrame:
    fields = event_runs(spark, folder).select(
        (F.col("run") * 100 + F.col("user_id")).alias("run"), F.col("event_type").alias("variable"), "value"
    )
    return preferred_variable(fields, ["run"], ["view", "click"], "seen")


@query(
    """
    SELECT CASE event_type WHEN 'click' THEN 'seen' WHEN 'view' THEN 'seen' ELSE event_type END AS variable,
           count(*) AS n_rows, min(value) AS lowest
    FROM events GROUP BY 1
    """
)
def variable_one_name(spark: SparkSession, folder: str) -> DataFrame:
    fields = one_name(table(spark, folder, "events"), {"click": "seen", "view": "seen"}, "event_type")
    wide = preferred_column(fields, ["avg_value", "value"], "chosen")
    return wide.groupBy(F.col("event_type").alias("variable")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("chosen").alias("lowest")
    )


@query(
    """
    WITH batch AS (
        SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice + 1 AS o_totalprice, 1 AS seq
        FROM orders WHERE o_orderstatus = 'P'
        UNION ALL
        SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER), o_totalprice + 2, 2
        FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'
        UNION ALL
        SELECT -1 - o_orderkey, CAST(year(o_orderdate) AS INTEGER), o_totalprice, 1
        FROM orders WHERE o_orderpriority = '5-LOW'
    ), newest AS (
        SELECT o_orderkey, year, arg_max(o_totalprice, seq) AS o_totalprice FROM batch GROUP BY o_orderkey, year
    )
    SELECT * FROM newest
    UNION ALL
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM newest n WHERE n.o_orderkey = orders.o_orderkey
                      AND n.year = year(orders.o_orderdate))
    """
)
def keyed_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """A partitioned table that takes a batch with changed, repeated and new keys; the batch is applied twice."""
    orders = order_months(spark, folder).select(
        "o_orderkey", "year", "o_totalprice", "o_orderstatus", "o_orderpriority"
    )

    def rows(df: DataFrame, key, add: int, sequence: int) -> DataFrame:
        return df.select(
            key.alias("o_orderkey"), "year", (F.col("o_totalprice") + add).alias("o_totalprice"), F.lit(sequence).alias("seq")
        )

    pending = orders.where("o_orderstatus = 'P'")
    batch = (
        rows(pending, F.col("o_orderkey"), 1, 1)
        .unionByName(rows(pending.where("o_orderpriority = '1-URGENT'"), F.col("o_orderkey"), 2, 2))
        .unionByName(rows(orders.where("o_orderpriority = '5-LOW'"), -1 - F.col("o_orderkey"), 0, 1))
    )
    path = fresh_folder(spark, "upserted")
    first = orders.select("o_orderkey", "year", "o_totalprice")
    for part, sequence in ((first, None), (batch, "seq"), (batch, "seq")):
        tables.upsert_into(spark, path, part, ["o_orderkey", "year"], ["year"], sequence)
    return tables.read_table(spark, path).select("o_orderkey", "year", "o_totalprice")


@query(
    """
    WITH batch AS (SELECT l_orderkey * 2 AS o_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT o_orderkey, 'already stored' AS reason FROM batch WHERE o_orderkey IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT o_orderkey, 'repeated in batch' FROM batch WHERE n > 1
    """
)
def strict_insert_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    batch = table(spark, folder, "lineitem").select((F.col("l_orderkey") * 2).alias("o_orderkey"))
    return tables.insert_conflicts(table(spark, folder, "orders"), batch, ["o_orderkey"])


@query(
    """
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1
    """
)
def key_violations(spark: SparkSession, folder: str) -> DataFrame:
    return tables.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """
    SELECT l.l_orderkey * 2 AS o_orderkey, l.l_partkey, l.l_linenumber, o.o_totalprice
    FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey * 2
    """
)
def batch_lookup(spark: SparkSession, folder: str) -> DataFrame:
    wanted = table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 2).alias("o_orderkey"), "l_partkey", "l_linenumber"
    )
    return tables.lookup(table(spark, folder, "orders"), wanted, ["o_orderkey"], ["o_totalprice"])


@query(
    f"""
    SELECT event_id, {EVENT_RUN} AS run, value FROM events WHERE {EVENT_RUN} >= 2024011500
    """
)
def retention_cutoff(spark: SparkSession, folder: str) -> DataFrame:
    return tables.retained(event_runs(spark, folder).select("event_id", "run", "value"), "run", 2024011500)


@query(
    f"""
    SELECT count(*) FILTER ({EVENT_RUN} < 2024011500) AS rows_to_delete,
           count(*) FILTER ({EVENT_RUN} >= 2024011500) AS rows_to_keep
    FROM events
    """
)
def retention_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tables.retention_report(event_runs(spark, folder), "run", 2024011500)


@query(
    f"""
    SELECT event_id, {EVENT_RUN} AS run, event_type, value FROM events WHERE {EVENT_RUN} >= 2024011506
    """
)
def retention_delete(spark: SparkSession, folder: str) -> DataFrame:
    """A table by day after a delete on its own path: whole days go, one day is rewritten, later days stay."""
    path = fresh_folder(spark, "runs")
    rows = event_runs(spark, folder).select("event_id", "run", "event_type", "value").withColumn("day", F.floor(F.col("run") / 100))
    rows.hint("rebalance", "day").write.partitionBy("day").parquet(path)
    tables.delete_below(spark, path, "run", 2024011506, ["day"])
    return tables.read_table(spark, path).drop("day")


@query(
    f"""
    SELECT o_orderkey, CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) // 2 AS INTEGER) AS slot, {ORDER_CENTS} + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS cents
    FROM orders
    """
)
def upsert_many_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """A batch that touches over a thousand partitions of two days each."""
    path = fresh_folder(spark, "slots")
    slot = F.floor(F.date_diff("o_orderdate", F.lit("1995-01-01")) / 2).cast("int")
    rows = table(spark, folder, "orders").select("o_orderkey", slot.alias("slot"), cents("o_totalprice").alias("cents"))
    for part in (rows, rows.where("o_orderkey % 3 = 0").withColumn("cents", F.col("cents") + 1)):
        tables.upsert_into(spark, path, part, ["o_orderkey", "slot"], ["slot"])
    return tables.read_table(spark, path)


@query(
    f"""
    SELECT event_id, {EVENT_RUN} AS run, event_type || ': ' || user_id % 3 || '%' AS kind, printf('%02d', user_id % 7) AS lot
    FROM events WHERE {EVENT_RUN} >= 2024011506
    """
)
def retention_odd_names(spark: SparkSession, folder: str) -> DataFrame:
    """A delete in a folder with a blank, whose text partitions have colons, blanks, percent signs and leading zeros."""
    path = f"{fresh_folder(spark, 'odd')}/runs of 2024"
    kind = F.concat("event_type", F.lit(": "), F.col("user_id") % 3, F.lit("%"))
    rows = event_runs(spark, folder).select("event_id", "run", kind.alias("kind"), F.format_string("%02d", F.col("user_id") % 7).alias("lot"))
    tables.upsert_into(spark, path, rows, ["event_id", "kind", "lot"], ["kind", "lot"])
    tables.delete_below(spark, path, "run", 2024011506)
    return tables.read_table(spark, path)


@query(
    f"""
    SELECT o_orderkey, printf('%02d', month(o_orderdate)) AS region, {ORDER_CENTS} + CASE WHEN o_orderkey % 5 = 0 THEN 7 ELSE 0 END AS cents
    FROM orders
    """
)
def upsert_text_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """Partitions named 01 to 12, which are texts and stay texts."""
    path = fresh_folder(spark, "regions")
    region = F.format_string("%02d", F.month("o_orderdate"))
    rows = table(spark, folder, "orders").select("o_orderkey", region.alias("region"), cents("o_totalprice").alias("cents"))
    for part in (rows, rows.where("o_orderkey % 5 = 0").withColumn("cents", F.col("cents") + 7)):
        tables.upsert_into(spark, path, part, ["o_orderkey", "region"], ["region"])
    return tables.read_table(spark, path)


@query(
    """
    SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS month, 'stored' AS part FROM orders WHERE o_orderkey % 10 <> 0
    UNION ALL SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER), 'added' FROM orders WHERE o_orderkey % 10 = 0
    """
)
def strict_insert_indexed(spark: SparkSession, folder: str) -> DataFrame:
    """Two lots go in by a key index, the second, repeated, is refused whole."""
    path = fresh_folder(spark, "indexed")
    rows = table(spark, folder, "orders").select("o_orderkey", F.month("o_orderdate").alias("month"))
    added = rows.where("o_orderkey % 10 = 0").withColumn("part", F.lit("added"))
    tables.strict_insert(spark, path, rows.where("o_orderkey % 10 <> 0").withColumn("part", F.lit("stored")), ["o_orderkey"], ["month"])
    tables.strict_insert(spark, path, added, ["o_orderkey"], ["month"])
    try:
        tables.strict_insert(spark, path, added, ["o_orderkey"], ["month"])
    except ValueError:
        return tables.read_table(spark, path)
    raise AssertionError("A repeated lot was accepted.")


@query(
    f"""
    SELECT l.l_orderkey * 2 AS o_orderkey, l.l_partkey, l.l_linenumber, {ORDER_CENTS} + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS cents
    FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey * 2
    UNION ALL SELECT -1 - o_orderkey, CAST(0 AS BIGINT), CAST(0 AS INTEGER), CAST(1 AS BIGINT) FROM orders WHERE o_orderkey % 3 = 0
    """
)
def bucketed_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Point lookups in a table bucketed by key after an upsert with changed and new keys."""
    name = f"orders_{uuid.uuid4().hex}"
    rows = table(spark, folder, "orders").select("o_orderkey", cents("o_totalprice").alias("cents"))
    create_bucketed(rows, name, fresh_folder(spark, "bucketed"), ["o_orderkey"], 16)
    third = rows.where("o_orderkey % 3 = 0")
    new = third.select((-1 - F.col("o_orderkey")).alias("o_orderkey"), F.lit(1).cast("long").alias("cents"))
    stored = upsert_bucketed(spark, name, third.withColumn("cents", F.col("cents") + 1).unionByName(new), ["o_orderkey"])
    lines = table(spark, folder, "lineitem").select((F.col("l_orderkey") * 2).alias("o_orderkey"), "l_partkey", "l_linenumber")
    none = new.select("o_orderkey", F.lit(0).cast("long").alias("l_partkey"), F.lit(0).alias("l_linenumber"))
    return tables.lookup(stored, lines.unionByName(none), ["o_orderkey"], ["cents"])


@query(f"SELECT max({EVENT_RUN}) AS run FROM events")
def latest_run(spark: SparkSession, folder: str) -> DataFrame:
    return tables.latest(event_runs(spark, folder), "run")


@query(
    """
    SELECT event_type, event_id, ts, value FROM (
        SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id DESC) AS r FROM events
    ) WHERE r = 1
    """
)
def latest_by_key(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    newest = tables.latest_by_key(events, ["event_type", "user_id"], "event_id")
    return newest.select("event_type", "event_id", "ts", "value")


@query(
    f"""
    SELECT l_returnflag AS series, {LINE_MONTH}, CAST(sum({LINE_CENTS}) AS DOUBLE) / count(*) AS "value [mm]"
    FROM lineitem GROUP BY ALL
    """
)
def renamed_value(spark: SparkSession, folder: str) -> DataFrame:
    means = ensemble_mean(
        line_months(spark, folder).withColumnRenamed("l_returnflag", "series"), ["series", "year", "month"], ["cents"]
    )
    return tables.rename_columns(means, {"cents": "value [mm]"})
