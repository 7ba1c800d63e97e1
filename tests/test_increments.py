"""Stored moments, preambles by line count, and complete and late runs."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from basinspark.operators import moments, skill
from basinspark.sources.preamble import read_below
from basinspark.streaming.completeness import followed_runs


def test_merged_moments_give_the_scores_of_all_pairs(spark, tmp_path):
    source = np.random.default_rng(1)
    frame = pd.DataFrame({"run": np.arange(300) % 7, "g": np.arange(300) % 2, "pred": source.normal(1000, 3, 300), "obs": source.normal(1001, 2, 300)})
    frame.loc[5, "pred"] = None
    frame.loc[6, "obs"] = float("nan")
    pairs, path = spark.createDataFrame(frame), str(tmp_path / "moments")
    for lot in (pairs.where("run < 3"), pairs.where("run = 3 AND obs > 1001"), pairs.where("run >= 3"), pairs.where("run < 2")):
        moments.store_moments(spark, path, lot, "run", ["g"], centre=1000.0)
    for scaling in ("obs_raw", "obs_std"):
        whole = {r["g"]: r.asDict() for r in skill.skill(pairs, ["g"], scaling=scaling).collect()}
        for row in moments.stored_skill(spark, path, ["g"], scaling).collect():
            assert row.asDict() == pytest.approx(whole[row["g"]], rel=1e-6)
    complete = frame.dropna()
    means = {r["g"]: (r["mean_p"], r["mean_o"]) for r in moments.means_of(moments.read_table(spark, path), ["g"], centre=1000.0).collect()}
    for g, part in complete.groupby("g"):
        assert means[g] == pytest.approx((part["pred"].mean(), part["obs"].mean()))


def test_preambles_by_line_count(spark, tmp_path):
    for lake, n in (("erie", 3), ("superior", 400)):
        lines = ["Observed values, 1, 2", "", "# no mark, 3", " Year , v \r"] + [f"{1900 + i}, {i * 0.5} \r" if i % 2 else f"{1900 + i},NaN\r" for i in range(n)] + ["\r"]
        (tmp_path / f"Lake{lake}_Monthly.csv").write_text("\n".join(lines))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for limit in (size, "512"):  # the second cuts the larger file into several pieces
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
        spark.conf.set("spark.sql.files.openCostInBytes", "0" if limit == "512" else "4194304")
        try:
            schema = spark.createDataFrame([], "Year int, v double").schema
            found = read_below(spark, str(tmp_path), schema, 3, name_pattern="Lake([a-z]+)_", name_columns=("lake",))
            rows = sorted((r["lake"], r["Year"], r["v"]) for r in found.where("v IS NOT NULL").collect())
            assert rows == sorted((lake, 1900 + i, i * 0.5) for lake, n in (("erie", 3), ("superior", 400)) for i in range(n) if i % 2)
            assert found.count() == 403
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_runs_are_released_once_or_reported_late(spark, tmp_path):
    start, expected = dt.datetime(2025, 1, 1), 70
    source, reports, progress = (str(tmp_path / name) for name in ("in", "out", "progress"))

    def arrive(*parts):
        rows = [(run, start + dt.timedelta(hours=6 * run), n) for run, numbers in parts for n in numbers]
        spark.createDataFrame(rows, "run long, run_ts timestamp, number int").write.mode("append").parquet(source)
        stream = spark.readStream.schema("run long, run_ts timestamp, number int").parquet(source)
        query = followed_runs(stream, expected, "12 hours").writeStream.outputMode("append").option("checkpointLocation", progress).trigger(availableNow=True)
        query.format("parquet").option("path", reports).start().awaitTermination()
        return sorted((r["run"], r["status"], r["n_values"]) for r in spark.read.schema("run long, status string, n_values int").parquet(reports).collect())

    everything = range(expected)
    assert arrive((0, everything), (1, range(60)), (2, [0, 0, 69])) == [(0, "complete", 70)]
    assert arrive((0, everything), (1, range(55, 70)), (1, [3]), (2, [999, -1])) == [(0, "complete", 70), (1, "complete", 70)]
    assert arrive((9, everything)) == [(0, "complete", 70), (1, "complete", 70), (2, "late", 2), (9, "complete", 70)]
    assert arrive((2, everything), (1, everything)) == [(0, "complete", 70), (1, "complete", 70), (2, "late", 2), (9, "complete", 70)]
