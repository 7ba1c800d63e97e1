"""Benchmark decontamination: q-gram lemma in diagonal bands, verified by banded alignment.

Texts are compared in lower case (A-Z) with single blanks, as UTF-8 bytes. Benchmark items are cut into overlapping
windows of ``window`` bytes every ``step`` bytes and of ``passage`` bytes every ``passage_step``. An exact excerpt of
``passage + passage_step - 1`` bytes (79) holds a whole short window, so it is always found; a shorter one need not be, if
the item is longer. The long windows find passages with more edits than a short window may have. A window of w bytes found with at most e edits shares at least w + 1 - q(e + 1) of its
q-grams with the text, and all of them on diagonals (place in the text less place in the window) that lie within e of
each other. Shared q-grams are therefore counted in overlapping bands of diagonals, and regions that reach the bound
are verified by an alignment inside their band. The filter loses no region within the edit budget.

The benchmark is the stated query set: its items are read in blocks of ``block_bytes``, and each block's index is
broadcast, so its size is bounded. Documents are independent rows; a text of any length is searched whole, in pieces that
overlap by more than a region.

Defined cases: NULL or empty texts and items match nothing; an item shorter than q bytes is matched exactly, if it has at
least one word; repeated rows get equal results; repeated items are each reported; a region is reported once per
document and item, the one with fewest edits first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basinspark.llm.common import lean

TABLE_BITS = 20
GAP = 256  # zero bytes between texts, longer than a band is wide


@dataclass(frozen=True)
class LeakParameters:
    q: int = 10
    edit_share: float = 0.08  # of a window's bytes
    window: int = 200
    step: int = 100
    passage: int = 60  # bytes of the short windows
    passage_step: int = 20
    band: int = 32  # more than the edits of a window
    common: int = 24  # q-grams of more windows are left out where the bound of the rest stays positive
    piece: int = 1 << 20  # bytes searched at a time
    block_bytes: int = 16 << 20  # of benchmark text to an index


def normal(text: str | None) -> bytes:
    return b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())


def gram_hashes(data: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the q bytes from each place on."""
    wide = np.zeros(max(0, len(data) - q + 1), dtype=np.uint64)
    for k in range(q):
        wide = wide * np.uint64(0x100000001B3) + data[k : k + len(wide)].astype(np.uint64)
    wide ^= wide >> np.uint64(31)
    wide *= np.uint64(0x9E3779B97F4A7C15)
    return wide ^ (wide >> np.uint64(29))


class LeakIndex:
    """The windows of a block of items with their q-grams."""

    def __init__(self, items: list[tuple[int, str | None]], params: LeakParameters):
        self.params, self.windows, self.item, self.exact = params, [], [], []
        self.n_windows: dict[int, int] = {}
        for number, (_, text) in enumerate(items):
            whole = normal(text)
            if len(whole) < params.q:
                if whole:
                    self.exact.append((number, whole))
                continue
            spans = set()
            for width, step in ((params.window, params.step), (params.passage, params.passage_step)):
                last = max(0, len(whole) - width)
                spans |= {(s, min(len(whole), s + width)) for s in (*range(0, last, step), last)}
            self.n_windows[number] = len(spans)
            for begin, end in sorted(spans):
                self.windows.append(whole[begin:end])
                self.item.append(number)
        self.ids = [key for key, _ in items]
        self.edits = [self._edits(len(w)) for w in self.windows]
        grams = [gram_hashes(np.frombuffer(w, dtype=np.uint8), params.q) for w in self.windows]
        hashes = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        window = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        _, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        rare = counts[inverse] <= params.common
        need_rare = np.bincount(window[rare], minlength=len(grams)) - params.q * np.array(self.edits, dtype=np.int64)
        need_all = np.bincount(window, minlength=len(grams)) - params.q * np.array(self.edits, dtype=np.int64)
        enough = need_rare >= np.maximum(1, need_all // 2)
        kept = rare | ~enough[window] if len(window) else rare
        self.bound = np.where(enough, need_rare, need_all)
        order = np.argsort(hashes[kept], kind="stable")
        self.place, self.window = place[kept][order], window[kept][order]
        self.keys, self.first = np.unique(hashes[kept][order], return_index=True)
        self.count = np.diff(np.append(self.first, len(order)))
        self.present = np.zeros(1 << TABLE_BITS, dtype=bool)
        self.present[(self.keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True

    def _edits(self, length: int) -> int:
        """The budget of a window, as far as the lemma leaves a q-gram to look for."""
        p = self.params
        return max(0, min(int(p.edit_share * length), p.band - 1, (length - p.q) // p.q))

    def regions(self, data: np.ndarray) -> list[tuple[int, int]]:
        """Window and first diagonal of each band that reaches the bound."""
        p = self.params
        hashes = gram_hashes(data, p.q)
        at = np.flatnonzero(self.present[(hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
        if not len(at) or not len(self.keys):
            return []
        found = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        right = self.keys[found] == hashes[at]
        at, found = at[right], found[right]
        counts = self.count[found]
        total = int(counts.sum())
        if not total:
            return []
        offset = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
        posting = np.repeat(self.first[found], counts) + offset
        window = self.window[posting]
        half = (np.repeat(at, counts) - self.place[posting] + p.window) // p.band  # diagonals are shifted to be positive
        width = (len(data) + p.window) // p.band + 3
        key = window * width + half
        cell = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)).astype(np.int64)
        next_cell = (((key + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)).astype(np.int64)
        last_cell = (((key - 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)).astype(np.int64)
        sums = np.bincount(cell, minlength=1 << 18)
        hopeful = sums[cell] + np.maximum(sums[next_cell], sums[last_cell]) >= self.bound[window]
        if not hopeful.any():
            return []
        keys, n = np.unique(key[hopeful], return_counts=True)
        own = dict(zip(keys.tolist(), n.tolist(), strict=True))
        result = []
        for k in sorted({*own, *(x - 1 for x in own)}):
            w = (k + 1) // width if k not in own else k // width
            if own.get(k, 0) + own.get(k + 1, 0) >= self.bound[w]:
                result.append((w, (k - w * width) * p.band - p.window))
        return result

    def matches(self, data: np.ndarray, regions: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
        """Verified regions: number of the region, edits, begin and end. Regions are (window, first diagonal, bounds)."""
        raw, found, open_ = data.tobytes(), [], []
        for n, (w, diagonal, lo, hi) in enumerate(regions):
            pattern, spread = self.windows[w], 2 * self.params.band
            at = raw.find(pattern, max(lo, diagonal), min(hi, diagonal + spread + len(pattern)))
            if at >= 0:
                found.append((n, 0, at, at + len(pattern)))
            else:
                open_.append(n)
        open_.sort(key=lambda n: -len(self.windows[regions[n][0]]))
        for k in range(0, len(open_), 2048):
            part = open_[k : k + 2048]
            most = max(self.edits[regions[n][0]] for n in part)
            costs = aligned(
                [self.windows[regions[n][0]] for n in part], data, np.array([regions[n][1] - most for n in part]), 2 * self.params.band + 2 * most,
                np.array([regions[n][2:] for n in part]),
            )
            found += [(n, *c) for n, c in zip(part, costs, strict=True) if c[0] <= self.edits[regions[n][0]]]
        return found


def aligned(patterns: list[bytes], data: np.ndarray, diagonals: np.ndarray, width: int, bounds: np.ndarray) -> list[tuple[int, int, int]]:
    """Per pattern the least edits against any part of the data whose path stays on ``width`` diagonals, with begin and end.

    All patterns (longest first) advance together by a byte at a time; a row holds the best cost on each diagonal, and
    begins are carried along. Bytes beyond the bounds match nothing.
    """
    lengths = np.array([len(x) for x in patterns])
    longest = int(lengths[0])
    codes = np.zeros((len(patterns), longest), dtype=np.int16)
    for i, x in enumerate(patterns):
        codes[i, : len(x)] = np.frombuffer(x, dtype=np.uint8)
    places = diagonals[:, None] + np.arange(longest + width)
    texts = np.where((places >= bounds[:, :1]) & (places < bounds[:, 1:]), data[np.clip(places, 0, len(data) - 1)], np.int16(-1))
    steps = np.arange(width)
    cost = np.zeros((len(patterns), width), dtype=np.int64)
    origin = diagonals[:, None] + steps
    active = np.searchsorted(-lengths, -np.arange(1, longest + 1), side="right")
    for i in range(longest):
        k = active[i]
        best = cost[:k] + (texts[:k, i : i + width] != codes[:k, i : i + 1])
        first = origin[:k].copy()
        skip = cost[:k, 1:] + 1
        better = skip < best[:, :-1]
        best[:, :-1][better] = skip[better]
        first[:, :-1][better] = origin[:k, 1:][better]
        run = np.minimum.accumulate((best - steps) * width + steps, axis=1)  # the cheapest diagonal to insert from
        source = run % width
        cost[:k] = (run - source) // width + steps
        origin[:k] = np.take_along_axis(first, source, axis=1)
    at = cost.argmin(axis=1)
    rows = np.arange(len(patterns))
    ends = np.minimum(diagonals + at + lengths, bounds[:, 1])
    return list(zip(cost[rows, at].tolist(), np.maximum(origin[rows, at], bounds[:, 0]).tolist(), ends.tolist(), strict=True))


RESULT = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int32()), ("windows", pa.int32()), ("of_windows", pa.int32()), ("first_word", pa.int32()), ("last_word", pa.int32())]))
RESULT_SQL = "array<struct<item_id:bigint,edits:int,windows:int,of_windows:int,first_word:int,last_word:int>>"


def _pieces(texts: list[bytes], size: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (text number, offset, bytes) of about ``size`` bytes; longer texts in pieces that overlap."""
    group, total = [], 0
    for i, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - 1024), size):
            piece = text[offset : offset + size + 1024]
            group.append((i, offset, piece))
            total += len(piece)
            if total >= size:
                yield group
                group, total = [], 0
    if group:
        yield group


def leaks_of(texts: list[str | None], index: LeakIndex) -> list[list[dict]]:
    """Leaks of each text: per item its best region with its edits and words, and how many of its windows were found."""
    normals = [normal(t) for t in texts]
    found: list[dict[int, list]] = [{} for _ in texts]
    for group in _pieces(normals, index.params.piece):
        starts = np.cumsum([0] + [len(x) + GAP for _, _, x in group])
        data = np.frombuffer((b"\0" * GAP).join(x for _, _, x in group) + b"\0" * GAP, dtype=np.uint8)
        regions = []
        for w, diagonal in index.regions(data):
            # the text is that of the region's middle, or the nearest if a band reaches into the gap before it
            middle = min(max(diagonal + index.params.band + len(index.windows[w]) // 2, 0), len(data) - 1)
            k = min(int(np.searchsorted(starts, middle + GAP // 2, side="right")) - 1, len(group) - 1)
            regions.append((w, diagonal, int(starts[k]), int(starts[k + 1]) - GAP))
        for n, edits, begin, end in index.matches(data, regions):
            w, _, lo, _ = regions[n]
            i, offset, _ = group[int(np.searchsorted(starts, lo, side="right")) - 1]
            own = found[i].setdefault(index.item[w], [edits, begin - lo + offset, end - lo + offset, set()])
            if (edits, begin - lo + offset) < (own[0], own[1]):
                own[:3] = edits, begin - lo + offset, end - lo + offset
            own[3].add(w)
    out = []
    for text, own in zip(normals, found, strict=True):
        rows = [
            {
                "item_id": index.ids[item], "edits": edits, "windows": len(ws), "of_windows": index.n_windows[item],
                "first_word": text.count(b" ", 0, begin), "last_word": text.count(b" ", 0, end),
            }
            for item, (edits, begin, end, ws) in sorted(own.items())
        ]
        spaced = b" " + text + b" "
        for item, whole in index.exact:
            if b" " + whole + b" " in spaced:
                first = spaced[: spaced.index(b" " + whole + b" ")].count(b" ")
                rows.append({"item_id": index.ids[item], "edits": 0, "windows": 1, "of_windows": 1, "first_word": first, "last_word": first + whole.count(b" ")})
        out.append(rows)
    return out


def _searched(index):
    """Task function: add leaks to the last column of batches whose last but one is the text; ``index`` is broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before = batch.column(batch.num_columns - 1).to_pylist()
            now = leaks_of(batch.column(batch.num_columns - 2).to_pylist(), index.value)
            both = [(a or []) + b for a, b in zip(before, now, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(both, RESULT)], names=batch.schema.names)

    return run


def item_blocks(benchmark: DataFrame, item_id: str, text: str, size: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of at most so many characters (one item at least)."""
    block, total = [], 0
    rows = benchmark.where(F.col(text).isNotNull()).select(F.col(item_id).cast("long").alias("id"), F.col(text).alias("text"))
    for row in rows.orderBy("id", "text").toLocalIterator():
        if block and total + len(row["text"]) > size:
            yield block
            block, total = [], 0
        block.append((row["id"], row["text"]))
        total += len(row["text"])
    if block:
        yield block


def with_leaks(docs: DataFrame, benchmark: DataFrame, keep: list[Column], params: LeakParameters = LeakParameters(), text: str = "text", item_id: str = "item_id", item_text: str = "text", keep_text: bool = False) -> DataFrame:
    """The columns ``keep`` of every row with ``leaks``: item, edits, found windows of all its windows, words of the region.

    With ``keep_text`` the text follows ``keep`` as ``_text``, so that it need not go to the tasks twice.
    """
    rows = docs.select(*keep, F.col(text).alias("_text"), F.lit(None).cast(RESULT_SQL).alias("leaks"))
    schema = rows.schema
    for block in item_blocks(benchmark, item_id, item_text, params.block_bytes):
        index = docs.sparkSession.sparkContext.broadcast(LeakIndex(block, params))
        rows = rows.mapInArrow(lean(_searched(index)), schema)
    return rows if keep_text else rows.drop("_text")
