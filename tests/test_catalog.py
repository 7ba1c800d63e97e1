"""Every registered query against its SQL in DuckDB on the smallest test tables."""

from __future__ import annotations

import os

import numpy as np
import pytest
from oracle_check import connect, differences

import __spark_entry__ as contract
from basinspark.operators.models import KernelFeatures

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")

ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, connection, name):
    assert differences(contract.queries()[name](spark, FOLDER), connection, ORACLES[name]) == ""


def test_entry_and_names(spark):
    assert contract.entry(spark).columns == [
        "year", "month", "lake", "component", "mean_mm", "mean_cms", "lower_mm", "upper_mm",
    ]
    assert set(ORACLES) <= set(contract.queries())


def holdout_lines(connection):
    """Keys, inputs and prices of the training and the hold-out lines, as numpy."""
    rows = connection.sql("SELECT l_shipdate <= '1998-12-31' AS train, l_orderkey, l_partkey, l_linenumber, l_quantity, l_discount * 100, l_tax * 100, l_extendedprice / 1000 FROM lineitem WHERE l_shipdate >= '1995-01-01' AND l_shipdate <= '2001-12-31'").fetchall()
    parts = [[r[1:] for r in rows if bool(r[0]) == kind] for kind in (True, False)]
    return [([r[:3] for r in part], np.array([[float(x) for x in r[3:6]] for r in part]), np.array([float(r[6]) for r in part])) for part in parts]


def test_model_queries_return_every_prediction(spark, connection):
    """All hold-out lines by each model on three features, against direct fits."""
    (_, x, y), (keys, tested, price) = holdout_lines(connection)
    weights = np.linalg.lstsq(np.column_stack((x, np.ones(len(x)))), y, rcond=None)[0]
    direct = sorted((*k, v) for k, v in zip(keys, np.column_stack((tested, np.ones(len(tested)))) @ weights, strict=True))
    rows = contract.queries()["ensemble_scores"](spark, FOLDER).collect()
    by_model = {m: sorted((r["l_orderkey"], r["l_partkey"], r["l_linenumber"], r["y"]) for r in rows if r["model"] == m) for m in ("GP", "RF", "LR")}
    assert [r[:3] for r in by_model["LR"]] == [r[:3] for r in direct]
    assert [r[3] for r in by_model["LR"]] == pytest.approx([r[3] for r in direct], rel=1e-6)
    # the kernel model against ridge regression on the same random features, the forest within the range of its leaves
    mean, spread = x.mean(axis=0), x.std(axis=0)
    kernel = KernelFeatures(n_inputs=3)
    z = kernel.waves((x - mean) / spread)
    ridge = np.linalg.solve(z.T @ z + 0.1 * np.eye(kernel.n_features), z.T @ ((y - y.mean()) / y.std()))
    by_kernel = kernel.waves((tested - mean) / spread) @ ridge * y.std() + y.mean()
    expected = [v for *_, v in sorted((*k, v) for k, v in zip(keys, by_kernel, strict=True))]
    alone = {"GP": "kernel_predictions", "RF": "forest_predictions"}
    for model, query in alone.items():
        single = sorted((r["l_orderkey"], r["l_partkey"], r["l_linenumber"], r["y"]) for r in contract.queries()[query](spark, FOLDER).collect())
        for found in (by_model[model], single):
            assert [r[:3] for r in found] == [r[:3] for r in direct]
            values = np.array([r[3] for r in found])
            if model == "GP":
                assert values == pytest.approx(expected, rel=1e-4, abs=1e-4)
            else:
                assert y.min() <= values.min() and values.max() <= y.max() and values.std() > 0


def test_linear_scores_of_the_training_flow(spark, connection):
    """Hold-out scores of the linear model against least squares in numpy on cells summed up by DuckDB."""
    cells = connection.sql("""
        WITH runs AS (
            SELECT year(l_shipdate) AS y, month(l_shipdate) AS m, l_suppkey % 2 AS run, l_linenumber % 4 AS lake, l_partkey % 2 AS surface,
                   avg(CAST(round(l_extendedprice * 100) AS BIGINT)) / 1e5 AS a, avg(l_quantity) AS b, avg(l_discount * 100) AS c
            FROM lineitem GROUP BY ALL),
        whole AS (SELECT y, m, run FROM runs GROUP BY ALL HAVING count(*) = 8)
        SELECT y, m, lake, surface, avg(a), avg(b), avg(c) FROM runs JOIN whole USING (y, m, run) GROUP BY ALL ORDER BY y, m, lake, surface
    """).fetchall()
    quantities = dict(((r[0], r[1], r[2]), r[3]) for r in connection.sql("SELECT year(l_shipdate), month(l_shipdate), l_linenumber % 4, avg(l_quantity) FROM lineitem GROUP BY ALL").fetchall())
    months = sorted({r[:2] for r in cells})
    x = {m: [v for r in cells if r[:2] == m for v in r[4:]] + [float(m[1] == k) for k in range(1, 13)] for m in months}
    y = {m: [float(quantities[(*m, lake)]) * (i + 1) for lake in range(4) for i in range(4)] for m in months}
    fit, held = ([m for m in months if low <= m <= high] for low, high in (((1995, 1), (1998, 12)), ((1999, 1), (2001, 12))))
    a, b, c, d = (np.array([part[m] for m in chosen]) for part, chosen in ((x, fit), (y, fit), (x, held), (y, held)))
    scale = np.where(a.std(axis=0) > 0, a.std(axis=0), 1)
    inputs, judged = (a - a.mean(axis=0)) / scale, (c - a.mean(axis=0)) / scale
    weights = np.linalg.lstsq(inputs, (b - b.mean(axis=0)) / b.std(axis=0), rcond=1e-6)[0]
    truth = (d - b.mean(axis=0)) / b.std(axis=0)
    errors = ((judged @ weights - truth) ** 2).mean(axis=0)
    rows = contract.queries()["training_flow"](spark, FOLDER).collect()
    found = {r["target"]: (r["mse"], r["r2"]) for r in rows if r["model"] == "LR"}
    assert found["mean"][0] == pytest.approx(errors.mean(), rel=1e-4)
    assert sorted(v[0] for k, v in found.items() if k != "mean") == pytest.approx(sorted(errors), rel=1e-4)
    assert found["mean"][1] == pytest.approx((1 - errors / truth.var(axis=0)).mean(), rel=1e-4)
    assert {r["model"] for r in rows} == {"GP", "RF", "LR"}


def test_lengths_that_are_found_are_likelier(spark):
    rows = {r["kernel"]: r for r in contract.queries()["kernel_search"](spark, FOLDER).collect()}
    assert rows["found"]["log_likelihood"] >= rows["start"]["log_likelihood"] and rows["start"]["matern_length"] == 1.0
    assert min(rows["found"]["matern_length"], rows["found"]["quadratic_length"]) > 0


def test_training_flow_returns_scores(spark):
    scores = contract.queries()["training_flow"](spark, FOLDER).collect()
    assert {"model", "target", "mse", "r2"} <= set(scores[0].asDict()) and len({(r["model"], r["target"]) for r in scores}) == len(scores)
    assert all(r["mse"] >= 0 and r["r2"] <= 1 for r in scores)


@pytest.mark.parametrize("name", ["forest_predictions", "kernel_predictions", "ensemble_scores"])
def test_model_queries_score_every_row(spark, name):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet").where("l_shipdate >= '1999-01-01'").count()
    models = 3 if name == "ensemble_scores" else 1
    scored = contract.queries()[name](spark, FOLDER)
    assert scored.count() == lines * models and scored.where("y IS NULL").count() == 0
