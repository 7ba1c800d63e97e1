"""Readers, listings and keyed tables."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from basinspark.plans.verification import posterior_observations, residual_observations
from basinspark.schemas import RUN_KEY, RUN_TABLE
from basinspark.session import fresh_folder, persisted, scratch, shared_folder, size_checked
from basinspark.sources import grids, listings, tables
from basinspark.sources.delimited import nan_to_null, read_series, write_tsv


def rows(df):
    return sorted(tuple(row) for row in df.collect())


def test_nan_becomes_null(spark):
    df = nan_to_null(spark.createDataFrame([(1.0, "a"), (float("nan"), "b")], "`value [mm]` double, name string"))
    assert rows(df.where("`value [mm]` IS NULL").select("name")) == [("b",)]
    assert df.agg(F.avg("`value [mm]`")).first()[0] == 1.0


def test_tsv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("erie", 1.5), ("a b", None)], "lake string, `value [mm]` double")
    write_tsv(df, str(tmp_path / "out"))
    assert next((tmp_path / "out").glob("part-*.csv")).read_text().startswith("lake\tvalue [mm]\n")
    assert set(read_series(spark, str(tmp_path / "out"), df.schema, sep="\t").collect()) == set(df.collect())


def residual_text(missing: str) -> str:
    remark = "".join(f"# note {i}, not data \r\n" for i in range(11))
    header = "Year, Jan, Feb, Mar, Apr, May, Jun, Jul, Aug, Sep, Oct, Nov, Dec \r\n"
    return remark + header + f"1900,-150.0,{missing},2.0,3.0,4.0,5.0,6.0,7.0,8.0,9.0,10.0,11.0 \r\n"


def test_residual_observations(spark, tmp_path):
    (tmp_path / "LakeErie_MonthlyNetBasinSupply_1900to2025.csv").write_text(residual_text("-99990.0"), newline="")
    (tmp_path / "LakeStClair_MonthlyNetBasinSupply_1900to2025.csv").write_text(residual_text("1.0"), newline="")
    observed = residual_observations(spark, str(tmp_path), {"erie": 31 * 86400.0 * 1000}).collect()
    assert len(observed) == 11 and {r.lake for r in observed} == {"erie"} and {r.component for r in observed} == {"cnbs"}
    january = next(r for r in observed if r.month == 1)
    assert (january.year, january.observed) == (1900, pytest.approx(-150.0))
    assert 2 not in {r.month for r in observed}


def test_posterior_observations(spark, tmp_path):
    head = "Year,Month,Median,2.5 Percentile,97.5 Percentile\n"
    (tmp_path / "miHuronPrecip_MonthlyRun.csv").write_text(head + "1950.0,1.0,104.7,99.4,110.0\n1950.0,2.0,65.8,61.6,70.6\n")
    (tmp_path / "erieEvap_MonthlyRun.csv").write_text(head + "1950.0,1.0,3.5,1.0,4.0\n")
    (tmp_path / "superiorNBSC_MonthlyRun.csv").write_text(head + "1950.0,1.0,9.0,1.0,10.0\n")
    assert rows(posterior_observations(spark, str(tmp_path))) == [
        (1950, 1, "erie", "evaporation", 3.5),
        (1950, 1, "michigan-huron", "precipitation", 104.7),
        (1950, 2, "michigan-huron", "precipitation", 65.8),
    ]


@pytest.fixture(scope="module")
def manifest(spark):
    names = [
        "pgbf.01.2025051800.202506.avrg.grib.grb2",
        "pgbf.01.2025051800.202505.avrg.grib.grb2",
        "pgbf.01.2025051806.202505.avrg.grib.grb2",
        "pgbf.01.2025051800.202505.avrg.grib.grb2.idx",
        "flxf.01.2025051800.202505.avrg.grib.grb2",
    ]
    return spark.createDataFrame([(n,) for n in names], "name string")


def test_listing_filters(spark, manifest):
    assert listings.filter_names(manifest, "name", "prefix", "flxf").count() == 1
    assert listings.filter_names(manifest, "name", "suffix", "grb2").count() == 4
    assert listings.filter_names(manifest, "name", "middle", "01").count() == 0
    chosen = listings.select_run_files(manifest, "name", "pgbf.01.", "2025051800", "grb2")
    assert [r.name[19:25] for r in chosen.collect()] == ["202505", "202506"]
    fields = listings.name_fields(chosen, "name").first()
    assert (fields.forecast, fields.forecast_year, fields.forecast_month) == ("202505", 2025, 5)


def test_object_keys(spark):
    keys = ["cfs/00/monthly/pgb.x.grib.grb2", "cfs/00/monthly/flx.x.grib.grb2", "cfs/00/monthly/pgb.x.idx"]
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    found = listings.filter_keys(df, "key", "pgb", "grib.grb2", "cfs/00/")
    assert [r.path for r in found.collect()] == ["monthly/pgb.x.grib.grb2"]


def test_link_harvest(spark):
    html = """<html><!-- <a href="flx1.grib.grb2">x</a> --><script>var a='<a href="flx2.grib.grb2">';</script>
    <A class="k" HREF='flxf.a.grib.grb2'>a</A> <a href=flxf.b.grib.grb2>b</a> <a name="flxf">no</a>
    <a href="flxf.c.grib.grb2?x=1&amp;y=2">c</a> <a href="flxf.d&amp;e.grib.grb2">d</a><a href="pgbf.grib.grb2">p</a>
    <abbr href="flxf.f.grib.grb2">f</abbr><a href="flxf/sub/g.grib.grb2">g</a></html>"""
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    found = listings.harvest_links(pages, "html", F.lit("http://base/"), "flxf", "grib.grb2").collect()
    assert [r.href for r in found] == [
        "flxf.a.grib.grb2", "flxf.b.grib.grb2", "flxf.d&e.grib.grb2", "flxf/sub/g.grib.grb2",
    ]
    assert found[-1].file_name == "g.grib.grb2" and found[0].file_url == "http://base/flxf.a.grib.grb2"


def test_variable_alternatives(spark):
    grid = spark.createDataFrame(
        [(1, "avg_2t", 5.0), (1, "mean2t", 6.0), (2, "mean2t", 7.0), (2, "tp", 1.0)], "run int, variable string, value double"
    )
    chosen = grids.preferred_variable(grid, ["run"], ["avg_2t", "mean2t"], "t")
    assert rows(chosen.select("run", "value", "variable")) == [(1, 5.0, "t"), (2, 7.0, "t")]
    wide = spark.createDataFrame([(None, 2.0), (1.0, 3.0)], "avg_2t double, mean2t double")
    assert rows(grids.preferred_column(wide, ["none", "avg_2t", "mean2t"], "t").select("t")) == [(1.0,), (2.0,)]
    with pytest.raises(ValueError):
        grids.preferred_column(wide, ["none"], "t")


def run_rows(spark, *records):
    return spark.createDataFrame(records, RUN_TABLE)


def record(run, value, month=5, lake="erie"):
    return (run, 2025, month, lake, "lake", "precipitation", value)


def test_upsert_rewrites_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "runs")
    tables.upsert_into(spark, path, run_rows(spark, record(1, 1.0), record(1, 2.0, month=6)), RUN_KEY, ["year", "month"])
    untouched = sorted((tmp_path / "runs" / "year=2025" / "month=6").glob("*.parquet"))
    batch = run_rows(spark, record(1, 9.0), record(2, 3.0), record(2, 4.0)).withColumn(
        "seq", F.when(F.col("value [mm]") == 4.0, 2).otherwise(1)
    )
    for _ in range(2):
        tables.upsert_into(spark, path, batch, RUN_KEY, ["year", "month"], "seq")
    table = spark.read.parquet(path)
    assert rows(table.select("cfs_run", "month", "value [mm]")) == [(1, 5, 9.0), (1, 6, 2.0), (2, 5, 4.0)]
    assert sorted((tmp_path / "runs" / "year=2025" / "month=6").glob("*.parquet")) == untouched
    with pytest.raises(ValueError):
        tables.upsert_into(spark, path, batch, ["cfs_run"], ["year"])


def test_upsert_without_listed_partitions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "LITERAL_PARTITIONS", 0)
    path = str(tmp_path / "runs")
    tables.upsert_into(spark, path, run_rows(spark, record(1, 1.0), record(1, 2.0, month=6)), RUN_KEY, ["year", "month"])
    tables.upsert_into(spark, path, run_rows(spark, record(1, 7.0)), RUN_KEY, ["year", "month"])
    assert rows(spark.read.parquet(path).select("month", "value [mm]")) == [(5, 7.0), (6, 2.0)]


def test_strict_insert(spark, tmp_path):
    path = str(tmp_path / "runs")
    run_rows(spark, record(1, 1.0)).write.parquet(path)
    tables.strict_insert(spark, path, run_rows(spark, record(2, 1.0)), RUN_KEY)
    for batch in (run_rows(spark, record(2, 5.0)), run_rows(spark, record(3, 5.0), record(3, 6.0))):
        with pytest.raises(ValueError, match="Duplicate keys"):
            tables.strict_insert(spark, path, batch, RUN_KEY)
    assert spark.read.parquet(path).count() == 2


def test_append_lookup_retention(spark, tmp_path):
    path = str(tmp_path / "runs")
    data = run_rows(spark, record(2024073118, 1.0), record(2024080100, 2.0))
    with pytest.raises(ValueError, match="empty"):
        tables.append(data.limit(0), path)
    tables.append(data, path)
    tables.append(data, path)
    assert rows(tables.duplicate_keys(spark.read.parquet(path), ["cfs_run"])) == [(2024073118, 2), (2024080100, 2)]
    wanted = spark.createDataFrame([(2024080100,), (5,)], "cfs_run long")
    found = tables.lookup(data, wanted, ["cfs_run"], ["value [mm]"])
    assert {r["cfs_run"]: r["value [mm]"] for r in found.collect()} == {2024080100: 2.0, 5: None}
    assert tuple(tables.retention_report(data, "cfs_run", 2024080100).first()) == (1, 1)
    assert tables.delete_below(spark, path, "cfs_run", 1) == 0
    assert tables.delete_below(spark, path, "cfs_run", 2024080100) == 2
    assert rows(spark.read.parquet(path).select("cfs_run")) == [(2024080100,)] * 2
    assert tables.latest(data, "cfs_run").first()[0] == 2024080100
    assert tables.latest(data.limit(0), "cfs_run").first()[0] is None
    renamed = tables.rename_columns(data, {"value [mm]": "value"})
    assert renamed.columns[-1] == "value"


def test_shared_folder_and_size_check(spark):
    assert fresh_folder(spark, "x") != fresh_folder(spark, "x")
    df = spark.range(100).withColumn("odd name [mm]", F.rand())
    fixed = persisted(df)
    assert fixed.collect() == fixed.collect()

    def plan(side):
        return spark.range(10).join(side, "id")._jdf.queryExecution().toString()

    assert "strategy=broadcast" in plan(size_checked(df, most_bytes=3200))
    assert "strategy=broadcast" not in plan(size_checked(df, most_bytes=3199))
    long_texts = df.withColumn("text", F.repeat(F.lit("x"), 100))
    assert "strategy=broadcast" not in plan(size_checked(long_texts, most_bytes=13999))


def test_scratch_tables_go_with_their_scope(spark, tmp_path):
    before = set(os.listdir(shared_folder(spark).removeprefix("file:")))
    with scratch(spark):
        inner = persisted(spark.range(3))
        with scratch(spark):
            persisted(inner).count()
        assert inner.count() == 3
        assert len(set(os.listdir(shared_folder(spark).removeprefix("file:"))) - before) == 1
    assert set(os.listdir(shared_folder(spark).removeprefix("file:"))) == before


def test_files_are_deleted_or_rewritten_below_a_cutoff(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.createDataFrame([(1, 2000), (2, 2000)], "run long, year int").coalesce(1).write.partitionBy("year").parquet(path)
    spark.createDataFrame([(2, 2001), (5, 2001), (None, 2001)], "run long, year int").coalesce(1).write.mode("append").partitionBy("year").parquet(path)
    spark.createDataFrame([(7, 2002)], "run long, year int").coalesce(1).write.mode("append").partitionBy("year").parquet(path)
    untouched = {f for f in os.listdir(f"{path}/year=2002")}
    assert tables.delete_below(spark, path, "run", 3, ["year"]) == 3
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {(None, 2001), (5, 2001), (7, 2002)}
    assert untouched == {f for f in os.listdir(f"{path}/year=2002")}
