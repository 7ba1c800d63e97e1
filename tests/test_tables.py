"""Publish step, key index, bucketed tables, and tables with odd names."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from basinspark.sources import bucketed, key_index, publish, tables

STEPS = ["staged", "journalled", "move", "moved", "delete", "deleted", "cleared"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def table(spark, n, add=0):
    return spark.range(n).select(F.col("id"), F.format_string("%02d", F.col("id") % 3).alias("part"), (F.col("id") + add).alias("value"))


class Lost(Exception):
    pass


def failing(monkeypatch, step):
    def reached(name):
        if name == step:
            raise Lost(name)

    monkeypatch.setattr(publish, "_reached", reached)


@pytest.mark.parametrize("step", STEPS)
def test_a_lost_writer_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "table")
    keys, old = ["id", "part"], rows(table(spark, 9))
    tables.upsert_into(spark, path, table(spark, 9), keys, ["part"])
    batch = table(spark, 12, 100).where("part <> '02'")
    changed = sorted([r for r in old if r[1] == "02"] + rows(batch), key=repr)
    failing(monkeypatch, step)
    with pytest.raises(Lost):
        tables.upsert_into(spark, path, batch, keys, ["part"])
    monkeypatch.setattr(publish, "_reached", lambda name: None)
    found = rows(tables.read_table(spark, path).select("id", "part", "value"))
    assert found == (old if step == "staged" else changed)
    tables.upsert_into(spark, path, batch, keys, ["part"])  # the writer comes again
    assert rows(tables.read_table(spark, path).select("id", "part", "value")) == changed
    assert not os.path.exists(f"{path}/_publish") or not os.listdir(f"{path}/_publish")


@pytest.mark.parametrize("step", STEPS)
def test_a_lost_delete_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "table")
    table(spark, 30).coalesce(1).write.partitionBy("part").parquet(path)
    table(spark, 40).where("id >= 30").coalesce(1).write.mode("append").partitionBy("part").parquet(path)
    failing(monkeypatch, step)
    with pytest.raises(Lost):
        tables.delete_below(spark, path, "id", 20)
    monkeypatch.setattr(publish, "_reached", lambda name: None)
    assert sorted(r["id"] for r in tables.read_table(spark, path).collect()) == list(range(0 if step == "staged" else 20, 40))
    tables.delete_below(spark, path, "id", 20)
    assert sorted(r["id"] for r in tables.read_table(spark, path).collect()) == list(range(20, 40))


def test_deletes_in_folders_with_odd_names(spark, tmp_path):
    path = str(tmp_path / "a blank, 100%25 & more")
    data = spark.range(10).select("id", F.element_at(F.array(F.lit("a:b"), F.lit("01"), F.lit("x y%")), (F.col("id") % 3 + 1).cast("int")).alias("part"))
    data.write.partitionBy("part").parquet(path)
    assert tables.delete_below(spark, path, "id", 4) == 4
    found = spark.read.schema("id long, part string").parquet(path)
    assert rows(found) == rows(data.where("id >= 4"))
    low = found.where("part < 'a'").count()
    assert tables.delete_below(spark, path, "part", "a") == low > 0
    assert rows(spark.read.schema("id long, part string").parquet(path)) == rows(data.where("id >= 4 AND part >= 'a'"))


def test_text_partitions_stay_texts(spark, tmp_path):
    path = str(tmp_path / "regions")
    first = spark.createDataFrame([(1, "01", 1), (2, "1", 1), (3, None, 1)], "id int, region string, v int")
    tables.upsert_into(spark, path, first, ["id", "region"], ["region"])
    tables.upsert_into(spark, path, spark.createDataFrame([(1, "01", 2), (3, None, 3)], first.schema), ["id", "region"], ["region"])
    assert rows(tables.read_table(spark, path).select("id", "region", "v")) == [(1, "01", 2), (2, "1", 1), (3, None, 1), (3, None, 3)]
    with pytest.raises(ValueError, match="Duplicate keys"):
        tables.upsert_into(spark, path, first.unionByName(first), ["id", "region"], ["region"])


def test_first_strict_insert_and_an_index_for_a_table_without_one(spark, tmp_path):
    path = str(tmp_path / "new")
    tables.strict_insert(spark, path, table(spark, 5), ["id"], ["part"])
    tables.strict_insert(spark, path, table(spark, 8).where("id >= 5"), ["id"], ["part"])
    assert tables.read_table(spark, path).count() == 8 and tables.read_table(spark, path).schema["part"].dataType.simpleString() == "string"
    with pytest.raises(ValueError, match="key index"):
        tables.append(table(spark, 1), path)
    plain = str(tmp_path / "plain")
    table(spark, 6).write.partitionBy("part").parquet(plain)
    with pytest.raises(ValueError, match="Duplicate keys"):
        tables.strict_insert(spark, plain, table(spark, 7), ["id"], ["part"])
    tables.strict_insert(spark, plain, table(spark, 7).where("id = 6"), ["id"], ["part"])
    assert spark.read.parquet(plain).count() == 7


def test_only_partitions_that_can_hold_a_key_are_read(spark, tmp_path):
    path = str(tmp_path / "index")
    data = spark.range(20000).select("id", (F.col("id") % 50).cast("int").alias("part"))
    tables.strict_insert(spark, path, data, ["id"], ["part"])
    # keys of one partition, in a batch that says nothing of it: the partition of a row is not part of the key
    batch = spark.range(7, 8).select("id", F.lit(999).alias("part"))
    held = tables.may_hold(spark, path, batch, ["id"], ["part"])
    parts = {r[0] for r in held.select("part").distinct().collect()}
    assert 7 in parts and len(parts) < 15
    plan = held._jdf.queryExecution().toString()
    assert "PartitionFilters: [part" in plan
    with pytest.raises(ValueError, match="already stored"):
        tables.strict_insert(spark, path, batch, ["id"], ["part"])
    # every stored key has its bit, in a partition of its own
    assert len(key_index.candidates(spark, path, data, ["id"], ["part"])) == 50
    new = spark.range(10**9, 10**9 + 20).select("id", (F.col("id") % 50).cast("int").alias("part"))
    assert len(key_index.candidates(spark, path, new, ["id"], ["part"])) < 50
    assert key_index.candidates(spark, path, new.limit(0), ["id"], ["part"]) == []


def test_bits_of_keys_are_never_missed(spark, tmp_path):
    """Each lot has a size of its own; every key is found in its own partition."""
    path = str(tmp_path / "lots")
    for n, begin in ((10, 0), (5000, 100), (300, 100000)):
        lot = spark.range(begin, begin + n).select(F.col("id").cast("string").alias("k"), F.lit(str(n)).alias("part"))
        key_index.add_segment(lot, path, ["k", "part"], ["part"])
        assert key_index.candidates(spark, path, lot, ["k", "part"], ["part"]) == [f'{{"part":"{n}"}}']
        one = lot.limit(1)
        assert key_index.candidates(spark, path, one, ["k", "part"], ["part"]) == [f'{{"part":"{n}"}}']


def test_bucketed_tables_are_joined_where_they_lie(spark, tmp_path):
    name = "bucketed_test"
    stored = bucketed.create_bucketed(table(spark, 100), name, str(tmp_path / "home"), ["id"], 7)
    before = os.listdir(tmp_path / "home")
    batch = spark.createDataFrame([(5, "x", -1), (200, "y", -2)], "id long, part string, value long")
    new = bucketed.upsert_bucketed(spark, name, batch, ["id"])
    expected = {r[0]: r for r in rows(table(spark, 100))} | {r[0]: r for r in rows(batch)}
    assert rows(new.select("id", "part", "value")) == sorted(expected.values(), key=repr)
    after = os.listdir(tmp_path / "home")
    assert len(after) == 1 and after != before
    assert len([f for f in os.listdir(tmp_path / "home" / after[0]) if f.endswith(".parquet")]) == 7
    wanted = spark.createDataFrame([(5,), (7,), (999,)], "id long")
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = tables.lookup(new, wanted, ["id"], ["value"])
        assert rows(found) == [(5, -1), (7, 7), (999, None)]
        # one exchange, of the wanted keys into the seven buckets; none between the join and the scan of the table
        plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[1]
        assert plan.count("Exchange ") == plan.count("hashpartitioning(id") == 1 and "Bucketed: true" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
    with pytest.raises(ValueError, match="Duplicate keys"):
        bucketed.upsert_bucketed(spark, name, batch.unionByName(batch), ["id"])
    assert stored is not None
    spark.sql(f"DROP TABLE {name}")


def test_equal_sequences_have_one_winner(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (1, 0, "z")], "k int, seq int, v string")
    assert {tables.latest_by_key(df.repartition(n), ["k"], "seq").first()["v"] for n in (1, 2, 3)} == {"b"}
