"""Language identification: script ranges narrow the candidates, Viterbi labels spans of mixed-language text.

Each word gets a score per language from hashed character trigrams. Languages that were not seen in the word's script
are ruled out by the largest penalty. The best path over the words pays a penalty for each switch, so a text is cut
into spans, and the language with most letters in its spans is the prediction.

The scores are fitted on about ``sample_rows`` labelled texts (all if there are fewer). Every text is then scored whole.
Most texts provably have no better path than one language throughout; only the others run the Viterbi recursion, all
texts of a batch at a time.

Defined cases: a NULL text or one without a letter gives ``und``, score 0 and no span; a text in a script that no
learned language has is scored without narrowing; without any labelled text every prediction is ``und``; repeated rows
get equal results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basinspark.llm.common import extended, lean, sampled, sequences_by_time
from basinspark.llm.word_tables import LETTERS, WordScores, chunked, padded, trigram_cells

UNKNOWN = "und"

#: First code points of script ranges of letters; the number of the range is the script.
SCRIPT_STARTS = (0x0, 0x370, 0x400, 0x530, 0x590, 0x600, 0x700, 0x900, 0xE00, 0x10A0, 0x1100, 0x1E00, 0x1F00, 0x2000, 0x3040, 0x3100, 0x3400, 0xA000, 0xAC00, 0xD7B0, 0x20000)

BITS = 15


@dataclass(frozen=True)
class SpanParameters:
    switch: float = 12.0  # cost of a change of language, in nats
    worst: float = 4.0  # a word counts against a language by this much at most
    smoothing: float = 0.5
    sample_rows: int = 8000  # labelled texts that the scores are fitted on, about
    script_share: float = 0.01  # share of a language's letters that makes a script one of its own


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    logs: np.ndarray  # trigram cell x language
    scripts: np.ndarray  # script x language, boolean

    def score(self, words: list[str], worst: float) -> np.ndarray:
        """Per word: log likelihood less that of the best language, at least ``-worst``."""
        codes, offsets = padded([w.lower() for w in words])
        logs = self.logs[trigram_cells(codes, BITS)]
        logs[offsets[1:] - 1] = 0  # from a word's last letter into the next word
        sums = np.add.reduceat(logs, offsets, axis=0)
        allowed = self.scripts[script_of(codes[offsets + 1])]
        allowed |= ~allowed.any(axis=1, keepdims=True)
        best = np.where(allowed, sums, -np.inf).max(axis=1, keepdims=True)
        return np.where(allowed, np.maximum(sums - best, -worst), -worst).astype(np.float32)


def script_of(codes: np.ndarray) -> np.ndarray:
    return np.searchsorted(np.array(SCRIPT_STARTS), codes, side="right") - 1


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram and script counts of the words of each language; scripts follow the trigram cells."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            lang, words = lang.as_py(), LETTERS.findall((text.as_py() or "").lower())
            if not words:
                continue
            own = sums.setdefault(lang, np.zeros((1 << BITS) + len(SCRIPT_STARTS), dtype=np.int64))
            codes, offsets = padded(words)
            cells = np.delete(trigram_cells(codes, BITS), offsets[1:] - 1)
            own[: 1 << BITS] += np.bincount(cells, minlength=1 << BITS)
            own[1 << BITS :] += np.bincount(script_of(codes[codes != 32]), minlength=len(SCRIPT_STARTS))
    for lang, own in sums.items():
        cells = np.flatnonzero(own)
        columns = [pa.array([lang] * len(cells), pa.string()), pa.array(cells, pa.int32()), pa.array(own[cells], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "cell", "n"])


def fit_languages(labelled: DataFrame, params: SpanParameters = SpanParameters(), doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModel:
    """Fit on texts with a language; the counts that reach the driver have a row for each language and cell at most."""
    usable = labelled.where(F.col(lang).isNotNull() & (F.col(lang) != UNKNOWN))
    rows = sampled(usable, params.sample_rows, usable.select(lang).count(), doc_id).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = rows.mapInArrow(_counted, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    found = counts.toPandas()
    languages = tuple(sorted(found["lang"].unique()))
    sums = np.zeros(((1 << BITS) + len(SCRIPT_STARTS), len(languages)))
    sums[found["cell"].to_numpy(dtype=np.int64), np.searchsorted(languages, found["lang"].to_numpy(dtype=str)) if len(found) else []] = found["n"]
    grams, scripts = sums[: 1 << BITS] + params.smoothing, sums[1 << BITS :]
    logs = np.log(grams / grams.sum(axis=0, keepdims=True)).astype(np.float32)
    return LanguageModel(languages, logs, scripts >= params.script_share * np.maximum(scripts.sum(axis=0, keepdims=True), 1))


def needs_switches(scores: np.ndarray, switch: float) -> bool:
    """False if one language throughout is surely the best path.

    Against the best single language a, every span of another language b gains at most the largest sum of (b - a) over
    a run of words. A path with k such spans has at least k/2 switches, so a gain of no more than half a switch for
    each of them cannot pay.
    """
    gains = np.cumsum(scores - scores[:, [int(scores.sum(axis=0).argmax())]], axis=0, dtype=np.float64)
    before = np.minimum.accumulate(np.concatenate((np.zeros((1, scores.shape[1])), gains[:-1])), axis=0)
    return bool((gains - before).max() > switch / 2)


def best_paths(scores: np.ndarray, lengths: list[int], switch: float) -> np.ndarray:
    """Viterbi labels of sequences laid end to end, one step over all sequences at a time."""
    labels = np.zeros(len(scores), dtype=np.int32)
    order, starts, active = sequences_by_time(lengths)
    if not len(active):
        return labels
    width = scores.shape[1]
    kind = np.min_scalar_type(width - 1)  # one byte a language while there are few
    back = np.zeros((len(scores), width), dtype=kind)
    own = np.arange(width, dtype=kind)
    value = np.zeros((len(order), width))
    value[:] = scores[starts]
    for t in range(1, len(active)):
        now, at = value[: active[t]], starts[: active[t]] + t
        top = now.argmax(axis=1)
        moved = now[np.arange(len(now)), top] - switch
        stay = now >= moved[:, None]
        back[at] = np.where(stay, own, top[:, None])
        value[: active[t]] = np.where(stay, now, moved[:, None]) + scores[at]
    label = value.argmax(axis=1)
    for t in range(len(active) - 1, -1, -1):
        at = starts[: active[t]] + t
        labels[at] = label[: active[t]]
        label[: active[t]] = back[at, label[: active[t]]]
    return labels


#: Characters that are split into words at a time, and words whose texts wait for their paths together.
CHUNK = 2_000_000
WAITING_WORDS = 200_000

RESULT = "lang_pred string, score double, spans array<struct<begin:int,end:int,lang:string>>"
_ARROW_SPANS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))


def _summary(model: LanguageModel, words: list[str], scores: np.ndarray, labels: np.ndarray | None, text: str):
    """Prediction, score and spans of one text with letters."""
    if labels is None:
        best = int(scores.sum(axis=0).argmax())
        share, margin_of = 1.0, scores
        spans = [{"begin": 0, "end": len(text), "lang": model.languages[best]}]
    else:
        letters = np.bincount(labels, weights=[len(w) for w in words], minlength=len(model.languages))
        best = int(letters.argmax())
        share, margin_of = letters[best] / letters.sum(), scores[labels == best]
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(labels)) + 1, [len(labels)]))
        places = [m.start() for m in LETTERS.finditer(text)] if len(cuts) > 2 else [0]
        begins = [0] + [places[c] for c in cuts[1:-1]]
        spans = [
            {"begin": b, "end": e, "lang": model.languages[int(labels[c])]}
            for b, e, c in zip(begins, begins[1:] + [len(text)], cuts[:-1], strict=True)
        ]
    totals = margin_of.sum(axis=0, dtype=np.float64)
    rest = np.delete(totals, best)
    sure = 1 / (1 + np.exp(-min(50.0, totals[best] - rest.max()))) if len(rest) else 1.0
    return model.languages[best], float(share * sure), spans


def _labelled(model: LanguageModel, params: SpanParameters, keep_text: bool):
    """Task function: append prediction, score and spans to batches whose last column is the text, which can stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordScores(lambda words: model.score(words, params.worst), len(model.languages))
        for batch in batches:
            results: list[tuple] = [(UNKNOWN, 0.0, [])] * batch.num_rows
            texts = (t.as_py() for t in batch.column(batch.num_columns - 1))
            waiting: list[tuple[int, list[str], np.ndarray, str]] = []

            def decided(waiting=waiting, results=results) -> None:
                """Paths of the texts that wait, which are let go."""
                labels = best_paths(np.concatenate([x[2] for x in waiting]), [len(x[1]) for x in waiting], params.switch)
                ends = np.cumsum([len(x[1]) for x in waiting])
                for (i, ws, own, text), e in zip(waiting, ends, strict=True):
                    results[i] = _summary(model, ws, own, labels[e - len(ws) : e], text)
                waiting.clear()

            for first, run_ in chunked(texts if model.languages else [], CHUNK):
                found = [LETTERS.findall(t) for t in run_]
                scores = table.of([w for ws in found for w in ws])
                end = 0
                for i, ws in enumerate(found):
                    begin, end = end, end + len(ws)
                    if not ws:
                        continue
                    own = scores[begin:end]
                    if needs_switches(own, params.switch):
                        waiting.append((first + i, ws, own.copy(), run_[i]))
                    else:
                        results[first + i] = _summary(model, ws, own, None, run_[i])
                if sum(len(x[1]) for x in waiting) >= WAITING_WORDS:
                    decided()
            if waiting:
                decided()
            kept = batch.num_columns - (not keep_text)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:kept], pa.array([r[0] for r in results], pa.string()), pa.array([r[1] for r in results], pa.float64()), pa.array([r[2] for r in results], _ARROW_SPANS)],
                names=[*batch.schema.names[:kept], "lang_pred", "score", "spans"],
            )

    return run


def identified(docs: DataFrame, model: LanguageModel, keep: list[Column], params: SpanParameters = SpanParameters(), text: str = "text", keep_text: bool = False) -> DataFrame:
    """The columns ``keep`` of every row with ``lang_pred``, ``score`` and ``spans`` (offsets in characters of the text).

    With ``keep_text`` the text follows ``keep`` as ``_text``, so that it need not go to the tasks twice.
    """
    rows = docs.select(*keep, F.col(text).alias("_text"))
    return rows.mapInArrow(lean(_labelled(model, params, keep_text)), extended(rows, RESULT, keep_text))
