"""Toxicity: a linear-chain conditional random field tags toxic tokens; its marginals give document scores and offsets.

Labels are of documents, so tokens are labelled first: in a toxic document those words whose spelling (whole, or its
first letters) belongs almost only to toxic documents, and to nearly as many of them as the document's strongest such
spelling; every other token is clean. The field is fitted with forward-backward in numpy on about
``sample_documents`` labelled documents of each class. It then runs over every whole text: forward-backward one step
at a time over all texts of a batch, with the emission scores of distinct words kept in a bounded cache.

A document's score is a logistic function, fitted on the same sample, of its largest marginal, of the sum of its
marginals of at least 0.05, and of its length.

Defined cases: a NULL text or one without a letter scores as a text of clean tokens does; if either class has no
labelled text every score is the share of toxic labels, at most 0.499; repeated labels of a document count once,
toxic if any of them says so; repeated rows get equal results. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basinspark.llm.common import dropped, extended, lean, sampled, sequences_by_time, stored
from basinspark.llm.word_tables import LETTERS, WordScores, chunked
from basinspark.session import broadcast_if_small


@dataclass(frozen=True)
class ToxicParameters:
    sample_documents: int = 2500  # of each class, about; the fit sees no more
    sample_sequences: int = 12000  # token runs that the field is fitted on
    run_tokens: int = 40  # length of such a run; scoring has no such limit
    most_spellings: int = 200_000  # toxic spellings that tokens are labelled by, the most frequent ones
    bits: int = 16  # feature cells
    precision: float = 0.95  # of a spelling's documents, the share that must be toxic
    near: float = 0.2  # of the documents of the strongest spelling in a document, the share another needs
    common: float = 0.015  # of all toxic documents, the share that a toxic spelling needs
    steps: int = 50
    rate: float = 0.3
    penalty: float = 1e-5


@dataclass(frozen=True)
class ToxicModel:
    weights: np.ndarray | None  # log odds of toxic per feature cell
    moves: np.ndarray  # 2 x 2 scores of clean and toxic following each other
    document: tuple[float, ...]  # bias and the weights of document_facts
    bits: int
    rate: float  # share of toxic documents, used alone where nothing could be fitted


def spellings(word: str) -> list[str]:
    """Whole word, first letters and last letters, each marked by its kind."""
    return ["=" + word, *("^" + word[:k] for k in range(3, 9) if len(word) > k), *("$" + word[-k:] for k in (3, 4) if len(word) > k), "*"]


def feature_cells(words: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the features of all words laid end to end, and where each word's begin."""
    lists = [spellings(w) for w in words]
    cells = np.fromiter((zlib.crc32(f.encode()) >> (32 - bits) for fs in lists for f in fs), dtype=np.int64)
    return cells, np.concatenate(([0], np.cumsum([len(fs) for fs in lists])[:-1])).astype(np.int64)


def label_spellings(word: str) -> list[str]:
    """Those spellings by which a word is labelled: the whole word and its first letters."""
    return [s for s in spellings(word) if s[0] in "=^"]


def token_labels(words: list[str], strong: dict[str, int], near: float) -> np.ndarray:
    """Labels of the tokens of a toxic document: words with a strong spelling, near the strongest one of the document."""
    known: dict[str, int] = {}
    for w in words:
        if w not in known:
            known[w] = max(strong.get(s, 0) for s in label_spellings(w))
    strength = np.array([known[w] for w in words], dtype=float)
    return (strength > 0) & (strength >= near * strength.max(initial=0))


def forward_backward(odds: np.ndarray, lengths: list[int], moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginal probability of toxic for every token, and the expected counts of the four moves.

    In each state vector only the log odds of toxic against clean are carried, which is all that marginals need.
    """
    order, starts, active = sequences_by_time(lengths)
    p, expected = np.zeros(len(odds)), np.zeros((2, 2))
    if not len(active):
        return p, expected
    forward = np.zeros(len(odds))
    m = moves

    def onward(x: np.ndarray, into: np.ndarray) -> np.ndarray:
        return np.logaddexp(into[0, 1], x + into[1, 1]) - np.logaddexp(into[0, 0], x + into[1, 0])

    state = np.array(odds[starts], dtype=float)
    forward[starts] = state
    for t in range(1, len(active)):
        at = starts[: active[t]] + t
        state = onward(state[: active[t]], m) + odds[at]
        forward[at] = state
    beta = np.zeros(len(order))
    p[:] = forward
    for t in range(len(active) - 1, 0, -1):
        k, at = active[t], starts[: active[t]] + t
        p[at] += beta[:k]
        ahead = beta[:k] + odds[at]
        before = forward[at - 1]
        joint = np.stack((np.full(k, m[0, 0]), m[0, 1] + ahead, before + m[1, 0], before + m[1, 1] + ahead))
        joint = np.exp(joint - joint.max(axis=0))
        expected += (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)
        beta[:k] = onward(ahead, m.T)
    p[starts] += beta
    return 1 / (1 + np.exp(-np.clip(p, -60, 60))), expected


def fit_field(runs: list[tuple[list[str], np.ndarray]], params: ToxicParameters) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the feature cells and of the moves, fitted on labelled runs of tokens."""
    vocabulary = sorted({w for words, _ in runs for w in words})
    number = {w: i for i, w in enumerate(vocabulary)}
    cells, begins = feature_cells(vocabulary, params.bits)
    of_word = np.repeat(np.arange(len(vocabulary)), np.diff(np.append(begins, len(cells))))
    tokens = np.array([number[w] for words, _ in runs for w in words])
    truth = np.concatenate([own for _, own in runs]).astype(float)
    lengths = [len(words) for words, _ in runs]
    ends = np.cumsum(lengths)
    inner = np.ones(len(tokens), dtype=bool)
    inner[np.concatenate(([0], ends[:-1]))] = False
    pairs = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (truth[pairs - 1].astype(int), truth[pairs].astype(int)), 1)

    weights, moves = np.zeros(1 << params.bits), np.zeros((2, 2))
    slopes = [np.zeros_like(weights), np.zeros_like(moves)]
    squares = [np.zeros_like(weights), np.zeros_like(moves)]
    for step in range(1, params.steps + 1):
        emitted = np.add.reduceat(weights[cells], begins)
        p, expected = forward_backward(emitted[tokens], lengths, moves)
        by_word = np.bincount(tokens, weights=truth - p, minlength=len(vocabulary))
        gradient = [np.bincount(cells, weights=by_word[of_word], minlength=len(weights)) - params.penalty * len(tokens) * weights / 100, seen - expected]
        for value, g, slope, square in zip((weights, moves), gradient, slopes, squares, strict=True):
            slope += 0.1 * (g - slope)
            square += 0.05 * (g * g - square)
            value += params.rate * (slope / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.95**step)) + 1e-6)
    return weights.astype(np.float32), moves


def document_facts(p: np.ndarray) -> tuple[float, float, float]:
    """Log odds of the largest marginal, within 8 of even, logarithm of the toxic tokens and of all tokens, each plus one."""
    top = float(np.clip(p.max(initial=0.0), 3.3e-4, 1 - 3.3e-4))
    return float(np.log(top / (1 - top))), float(np.log1p(p[p >= 0.05].sum())), float(np.log1p(len(p)))


def document_score(model: ToxicModel, p: np.ndarray) -> float:
    odds = model.document[0] + float(np.dot(model.document[1:], document_facts(p)))
    return float(1 / (1 + np.exp(-np.clip(odds, -30, 30))))


def _logistic(facts: np.ndarray, truth: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton steps with a small penalty."""
    x = np.column_stack((np.ones(len(facts)), facts))
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (truth - p) - 0.1 * w
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)), slope)
    return tuple(float(v) for v in w)


def emissions(model: ToxicModel, words: list[str]) -> np.ndarray:
    """Log odds of toxic of distinct words, without their neighbours."""
    cells, begins = feature_cells([w.lower() for w in words], model.bits)
    return np.add.reduceat(model.weights[cells], begins)[:, None]


def marginals(model: ToxicModel, documents: list[list[str]], table: WordScores | None = None) -> list[np.ndarray]:
    """Toxic probability of each token of each tokenised document."""
    table = table or WordScores(lambda words: emissions(model, words), 1)
    odds = table.of([w for words in documents for w in words])[:, 0]
    lengths = [len(words) for words in documents]
    p, _ = forward_backward(odds, lengths, model.moves)
    return np.split(p, np.cumsum(lengths)[:-1])


#: Characters that are split into words at a time.
CHUNK = 3_000_000

RESULT = "score double, offsets array<struct<begin:int,end:int>>"
_ARROW_OFFSETS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))


def _scored(model: ToxicModel, keep_text: bool):
    """Task function: append score and offsets of toxic tokens to batches whose last column is the text, which can stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None if model.weights is None else WordScores(lambda words: emissions(model, words), 1)
        for batch in batches:
            scores, offsets = [], []
            for _, texts in chunked((t.as_py() for t in batch.column(batch.num_columns - 1)), CHUNK):
                if table is None:
                    scores += [model.rate] * len(texts)
                    offsets += [[]] * len(texts)
                    continue
                for text, p in zip(texts, marginals(model, [LETTERS.findall(t) for t in texts], table), strict=True):
                    scores.append(document_score(model, p))
                    bad = set(np.flatnonzero(p >= 0.5).tolist())
                    offsets.append([{"begin": m.start(), "end": m.end()} for i, m in enumerate(LETTERS.finditer(text)) if i in bad] if bad else [])
            kept = batch.num_columns - (not keep_text)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:kept], pa.array(scores, pa.float64()), pa.array(offsets, _ARROW_OFFSETS)], names=[*batch.schema.names[:kept], "score", "offsets"]
            )

    return run


def _spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: (toxic, text) to the number of documents of each class that hold a spelling."""
    own: tuple[Counter, Counter] = (Counter(), Counter())

    def counts() -> pa.RecordBatch:
        names = sorted(own[0].keys() | own[1].keys())
        columns = [pa.array(names, pa.string()), *(pa.array([side[n] for n in names], pa.int64()) for side in (own[1], own[0]))]
        own[0].clear()
        own[1].clear()
        return pa.RecordBatch.from_arrays(columns, names=["spelling", "own", "other"])

    for batch in batches:
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = {s for w in set(LETTERS.findall(text.lower())) for s in label_spellings(w)}
            own[toxic].update(found)
            if len(own[0]) + len(own[1]) > 1_000_000:
                yield counts()
    yield counts()


def _cut_in_runs(strong: dict[str, int], params: ToxicParameters):
    """Task function: (id, toxic, text) to runs of tokens with their labels; ``marked`` tells whether a run has a toxic one."""
    schema = pa.schema([("id", pa.string()), ("place", pa.int64()), ("marked", pa.bool_()), ("words", pa.string()), ("labels", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, toxic, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words = LETTERS.findall(text.lower())
                own = token_labels(words, strong, params.near) if toxic else np.zeros(len(words), dtype=bool)
                rows = []
                for k in range(0, len(words), params.run_tokens):
                    part = own[k : k + params.run_tokens]
                    rows.append({"id": key, "place": k, "marked": bool(part.any()), "words": " ".join(words[k : k + params.run_tokens]), "labels": part.tobytes()})
                yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def _facts_of(model: ToxicModel):
    """Task function: (toxic, text) to the facts that the document function reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordScores(lambda words: emissions(model, words), 1)
        for batch in batches:
            facts = []
            for _, texts in chunked(batch.column(1).to_pylist(), CHUNK):
                facts += [document_facts(p) for p in marginals(model, [LETTERS.findall(t.lower()) for t in texts], table)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([f[i] for f in facts], pa.float64()) for i in range(3))], names=["toxic", "a", "b", "c"])

    return run


def fit_toxicity(docs: DataFrame, labels: DataFrame, params: ToxicParameters = ToxicParameters(), doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> ToxicModel:
    """Fit on about ``sample_documents`` labelled documents of each class, however long they are.

    Tasks count the spellings, cut the texts in runs and find the facts of documents. The driver gets the spellings that
    are common and toxic (``most_spellings`` at most), ``sample_sequences`` runs of ``run_tokens``, and three numbers of
    each document; no text.
    """
    marked = labels.where(F.col(toxic).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.max(toxic).alias("_toxic"))
    counts = {r["_toxic"]: r["count"] for r in marked.groupBy("_toxic").count().collect()}
    chosen = None
    for value in (0, 1):
        rows = sampled(marked.where(F.col("_toxic") == value), params.sample_documents, counts.get(value, 0), "_id")
        chosen = rows if chosen is None else chosen.unionByName(rows)
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).where(F.col("_text").isNotNull())
    chosen, chosen_path = stored(chosen, "chosen")
    picked = texts.join(broadcast_if_small(chosen), "_id").select(F.col("_id").cast("string"), F.col("_toxic").cast("int"), "_text")
    picked, picked_path = stored(picked, "toxic-sample")
    spark, paths = docs.sparkSession, [chosen_path, picked_path]
    n = {r["_toxic"]: r["count"] for r in picked.groupBy("_toxic").count().collect()}
    rate = n.get(1, 0) / max(1, sum(n.values()))
    if not n.get(0) or not n.get(1):
        dropped(spark, *paths)
        return ToxicModel(None, np.zeros((2, 2)), (0.0,) * 4, params.bits, min(rate, 0.499))

    spelled = picked.select("_toxic", "_text").mapInArrow(_spelled, "spelling string, own long, other long")
    spelled = spelled.groupBy("spelling").agg(F.sum("own").alias("own"), F.sum("other").alias("other"))
    precise = F.col("own") / (F.col("own") + F.col("other") * F.lit(n[1] / n[0])) >= params.precision
    strong, strong_path = stored(spelled.where((F.col("own") > 0) & precise), "spellings")
    least = min(max(3.0, params.common * n[1]), strong.agg(F.max("own")).first()[0] or 1)
    common = strong.where(F.col("own") >= least).orderBy(F.desc("own"), "spelling").limit(params.most_spellings).collect()
    runs, runs_path = stored(picked.mapInArrow(_cut_in_runs({r["spelling"]: r["own"] for r in common}, params), "id string, place long, marked boolean, words string, labels binary"), "runs")
    totals = {r["marked"]: r["count"] for r in runs.groupBy("marked").count().collect()}
    runs = runs.withColumn("_key", F.xxhash64("id", "place"))
    wanted = None
    for kind in (True, False):
        part = sampled(runs.where(F.col("marked") == kind), params.sample_sequences // 2, totals.get(kind, 0), "_key")
        wanted = part if wanted is None else wanted.unionByName(part)
    found = wanted.orderBy("_key", "words").select("words", "labels").collect()  # as many as the parameters say, about
    weights, moves = fit_field([(r["words"].split(" "), np.frombuffer(r["labels"], dtype=bool)) for r in found], params)
    model = ToxicModel(weights, moves, (0.0,) * 4, params.bits, rate)
    facts = picked.select("_toxic", "_text").mapInArrow(_facts_of(model), "toxic int, a double, b double, c double").orderBy("toxic", "a", "b", "c").collect()
    dropped(spark, *paths, strong_path, runs_path)
    document = _logistic(np.array([r[1:] for r in facts]), np.array([r[0] for r in facts], dtype=float))
    return ToxicModel(weights, moves, document, params.bits, rate)


def toxicity_scored(docs: DataFrame, model: ToxicModel, keep: list[Column], text: str = "text", keep_text: bool = False) -> DataFrame:
    """The columns ``keep`` of every row with ``score`` and the ``offsets`` of toxic tokens in its text.

    With ``keep_text`` the text follows ``keep`` as ``_text``, so that it need not go to the tasks twice.
    """
    rows = docs.select(*keep, F.col(text).alias("_text"))
    return rows.mapInArrow(lean(_scored(model, keep_text)), extended(rows, RESULT, keep_text))
