"""The corpus pipeline stage by stage on a small folder, and the registered queries."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from basinspark.llm import common


@pytest.fixture(scope="module")
def folder(spark, docs, corpus, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(1)
    leak = "".join(rng.choice("klmnopqrst ") for _ in range(150))
    planted = spark.createDataFrame([(5000, corpus[1][1] + " " + leak, "en", "s1")], "doc_id long, text string, lang string, source string")
    names = ["doc_id", "text", "lang", "source"]
    docs.select(names).unionByName(planted).withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 8 == 1)) for i, *_ in corpus], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(0, leak)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_keep_and_drop(spark, folder, corpus):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, ids = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), docs.schema)
        assert docs.columns == columns
        ids[name] = [r[0] for r in docs.select("doc_id").collect()]
    assert not {1000, 1001, 1002, 1003} & set(ids["language"]) and None in ids["language"] and len(set(ids["language"])) >= 242
    gone = set(ids["language"]) - set(ids["toxicity"])
    assert sum(i % 8 == 1 for i in gone if i is not None) >= 28 and sum(i % 8 != 1 for i in gone if i is not None and i < 240) <= 2
    assert 10 in ids["duplicates"] and 11 not in ids["duplicates"] and 13 not in ids["duplicates"] and ids["duplicates"].count(1005) == 1
    if 5000 in ids["duplicates"]:
        assert 5000 not in ids["decontamination"]
    assert set(ids["decontamination"]) == set(ids["duplicates"]) - {5000}
    rows = corpus_pipeline.run(spark, folder).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(map(str, ids["decontamination"]))
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)


def test_rows_with_one_id_are_told_apart(spark, folder):
    """Copies go by their group, not by their id; of texts without words and of different texts with one id all stay."""
    text, other = " ".join(f"word{i}" for i in range(40)), " ".join(f"other{i}" for i in range(40))
    rows = [(3, text), (5, other), (5, text), (5, other + " tail"), (7, None), (7, ""), (None, text), (None, "some words of no other text"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((tuple(r) for r in corpus_pipeline.duplicates(spark, docs, folder).collect()), key=str)
    assert [r for r in kept if r[0] != 5] == sorted([(3, text), (7, None), (7, ""), (None, "some words of no other text"), (None, None)], key=str)
    assert [r[1].startswith(other) for r in kept if r[0] == 5] == [True]


@pytest.mark.parametrize("repeated", [False, True])
def test_texts_are_not_shuffled_to_drop_copies(spark, folder, tmp_path, repeated):
    """The rows that stay are found by a list of ids, the shorter one, beside which the texts keep their tasks."""
    rows = [(i, f"some words of text {i} and no other", "en") for i in range(40)] + [(40, "some words of text 1 and no other", "en")]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows + [(None, None, "en")] * repeated, "doc_id long, text string, lang string").write.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = corpus_pipeline.duplicates(spark, spark.read.parquet(path), folder)
        ids = [r[0] for r in found.collect()]
        plan = found._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(i for i in ids if i is not None) == list(range(40)) and len(ids) == 40 + repeated
    assert "SortMergeJoin" not in plan and "LeftAnti" in plan, plan


def test_stages_are_written_a_few_rows_at_a_time(spark, folder, monkeypatch):
    """The jobs that write a stage hold few rows at a time, the session's numbers come back, and the search of leaks gives memory back."""
    from basinspark.llm import decontamination

    names, within, given = list(common.FEW_ROWS), [], []
    before = {name: spark.conf.get(name) for name in names}
    write, give = corpus_pipeline.stored, decontamination.lean
    monkeypatch.setattr(corpus_pipeline, "stored", lambda df, name: (within.append({x: spark.conf.get(x) for x in names}), write(df, name))[1])
    monkeypatch.setattr(decontamination, "lean", lambda run: (given.append(run), give(run))[1])
    kept = dict(corpus_pipeline.STAGES)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(name, kept[name]) for name in ("decontamination", "mixture")])
    rows = corpus_pipeline.run(spark, folder)
    assert 5000 not in {r["doc_id"] for r in rows.collect()}
    assert within and given and all(int(w[x]) <= int(common.FEW_ROWS[x]) < int(before[x]) for w in within for x in names), within
    assert {name: spark.conf.get(name) for name in names} == before


def test_empty_table_passes_all_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0


def test_extra_columns_stay(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumns({"score": F.lit(1), "leaks": F.lit("x"), "lang_pred": F.lit(2)})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns


def test_one_query_for_each_operator():
    names = contract.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and set(contract.oracle_sql()) <= set(names)
