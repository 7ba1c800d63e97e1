"""Work and memory of the n-gram join on large groups of near copies."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from basinspark.llm import ngram_join


def near_copies(rng: random.Random, copies: int) -> list[str]:
    """A text of 150 words, and copies with one to four of the words replaced, so that many pairs just miss the threshold."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    texts = [base]
    for i in range(copies):
        words = list(base)
        for place in rng.sample(range(5, 145), 1 + rng.randrange(4)):
            words[place] = f"x{i}-{place}"
        texts.append(words)
    return [" ".join(words) for words in texts]


def test_group_of_near_copies_is_not_expanded(spark):
    copies = 400
    texts = near_copies(random.Random(5), copies)
    sets = [set(ngram_join.shingles(t, 0, 5).tolist()) for t in texts]
    least = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((least[a], least[b]))
                least = [low if x == high else x for x in least]
    counted = []

    class Join(ngram_join.NgramJoin):
        def linked(self, pairs):
            counted.append(pairs.count())
            return super().linked(pairs)

    join = Join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    try:
        found = {r["doc_id"]: r["component_id"] for r in join.members().collect()}
    finally:
        join.close()
    assert found == dict(enumerate(least))
    assert sum(counted) <= 15 * copies, counted


def test_frequent_shingles_take_little_beyond_their_block():
    rng = np.random.default_rng(1)
    texts = [" ".join(map(str, rng.integers(0, 10**9, 1000))) for _ in range(300)]
    texts += [texts[0] + " tail", texts[1] + " tail"]
    params = ngram_join.JoinParameters(heavy_block=310_000)
    batches = [pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])]
    tracemalloc.start()
    try:
        rows = [r for batch in ngram_join._digests(0, params)(iter(batches)) for r in batch.to_pylist()]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    often = {r["gram"]: r["copies"] for r in rows if r["gram"] is not None}
    both = [ngram_join.shingles(t, 0, 5) for t in (texts[0], texts[1])]
    assert often == {int(g): 2 for grams in both for g in grams.view(np.int64)}
    assert peak < 2.5 * 8 * params.heavy_block, peak


def test_tasks_hold_few_rows_and_give_memory_back(spark, monkeypatch):
    """Every job of the join runs with few rows at a time, the session's numbers stay, and a task ends by giving memory back."""
    from basinspark.llm import common

    names, within, given = list(common.FEW_ROWS), [], []
    before = {name: spark.conf.get(name) for name in names}
    write = ngram_join.stored
    monkeypatch.setattr(ngram_join, "stored", lambda df, name: (within.append({x: spark.conf.get(x) for x in names}), write(df, name))[1])
    rows = ngram_join.near_duplicates(spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")).collect()
    assert [r["component_id"] for r in rows] == [1, 1]
    assert within and all(int(w[x]) <= int(common.FEW_ROWS[x]) < int(before[x]) for w in within for x in names), within
    assert {name: spark.conf.get(name) for name in names} == before

    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["a b"])], names=["doc_id", "text"])
    assert list(common.lean(lambda batches: batches)(iter([batch]))) == [batch] and given == [1]
