"""Regression forests whose trees predict all targets jointly.

Every tree draws its own weight for each row (Poisson with mean 1, from a hash of seed, tree and row). A split is the one
with the greatest fall of squared error added up over all targets; every feature is tried at every node. Candidate
thresholds lie half-way between neighbouring values, of which each feature keeps at most ``bins``, evenly by rank.

No split parts rows whose features all fall into the same bins. Such rows are one *cell*: per tree its weight, its target
sums and the squares around its mean, which is all that a split or a leaf needs. Where there are at least ``fold`` rows to a
cell, one pass over the rows adds up the cells of all trees and growing works on those; otherwise each drawn row is a cell
of its own, made anew in every pass. The trees are the same.

Nodes with more than ``local_rows`` cells are split level by level for all trees in the same pass: tasks add up weights and
target sums by (node, feature, bin), Spark adds the sums of the tasks, and one row per node and feature reaches the driver.
A pass takes as many nodes as fit ``pass_bytes``. Smaller nodes are finished where their cells are: the cells move once, by
(tree, node), and each group, at most ``local_rows`` large, is grown to its leaves by one task. Groups that a lost executor
held are made again from the written rows or cells.

The trees are a table in the shared folder with one row per tree. Scoring sends them to the tasks in blocks of at most
``BLOCK_BYTES``, so a model of any number of trees can be used; ``depth`` bounds the size of a single one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basinspark.operators.distinct import by_distinct, lists, rows_of
from basinspark.session import persisted

#: Most bytes of trees that one scoring step broadcasts; a larger single tree is a step of its own.
BLOCK_BYTES = 64 << 20
#: Gains that differ by less than this share of a node's squared error count as equal; the first feature then wins.
EQUAL_GAIN = 1e-9
#: A node is pure when its squared error is below this share of its sum of squares, which is rounding.
PURE = 1e-18

TREE = "tree int, feature array<int>, threshold array<double>, left array<int>, right array<int>, value array<double>"
SUBTREE = "tree int, node int, feature array<int>, bin array<int>, left array<int>, right array<int>, value array<double>"
COPIES = "tree int, node int, bins binary, facts binary"
CELLS = "tree int, part int, n long, bins binary, facts binary"
#: Most bytes of cells that the tasks of one pass send; where more tasks would exceed it, partitions are joined.
SENT_BYTES = 8 << 30
#: Bytes of cells of one tree that one task puts together from those of all tasks.
PART_BYTES = 32 << 20


@dataclass(frozen=True)
class ForestParameters:
    trees: int = 100
    seed: int = 42
    depth: int = 30
    least_rows: int = 1  # weight that each side of a split must keep
    bins: int = 256
    local_rows: int = 100_000
    pass_bytes: int = 128 << 20
    fold: int = 8  # rows to a cell from which on cells are added up first


_STEPS = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 18)]))
#: Weight of each of 4,096 equal slices of the unit interval, and the slices that hold a step.
_SLICES = np.searchsorted(_STEPS, np.arange(4096) / 4096, side="right").astype(np.uint8)
_STEPPED = np.searchsorted(_STEPS, np.arange(1, 4097) / 4096, side="right") != _SLICES


def poisson_weights(ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a tree draws each row: Poisson with mean 1, a function of seed, tree and row alone."""
    state = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(((seed << 20) + tree + 1) * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        state = (state ^ (state >> np.uint64(shift))) * np.uint64(factor)
    state ^= state >> np.uint64(31)
    part = (state >> np.uint64(52)).astype(np.intp)
    weights = _SLICES[part].astype(np.int64)
    unsure = np.flatnonzero(_STEPPED[part])
    weights[unsure] = np.searchsorted(_STEPS, (state[unsure] >> np.uint64(11)).astype(np.float64) * 2.0**-53, side="right")
    return weights


def bins_of(x: np.ndarray, thresholds: Sequence[np.ndarray]) -> np.ndarray:
    """Bin of each value: ``x <= thresholds[b]`` exactly where the bin is at most ``b``."""
    return np.column_stack([np.searchsorted(t, x[:, f], side="left") for f, t in enumerate(thresholds)]).astype(np.uint16)


@dataclass
class Tree:
    """Nodes as arrays; a leaf has feature -1. ``value`` has one row per node and one column per target."""

    feature: np.ndarray
    split: np.ndarray  # bin or threshold: rows at or below it go left
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Node at which each row ends; ``x`` holds bins or values, as ``split`` does."""
        at = np.zeros(len(x), np.int64)
        moving = np.flatnonzero(self.feature[at] >= 0)
        while len(moving):
            node = at[moving]
            below = x[moving, self.feature[node]] <= self.split[node]
            at[moving] = np.where(below, self.left[node], self.right[node])
            moving = moving[self.feature[at[moving]] >= 0]
        return at


def _best_of_feature(node: np.ndarray, bins: np.ndarray, weights: np.ndarray, sums: np.ndarray, starts: np.ndarray, least: int, tolerance: np.ndarray):
    """For cells sorted by (node, bin): per node, from ``starts`` on, the best gain and the first bin that has it.

    ``sums`` are target sums around the node's mean, so those of a whole node are zero.
    """
    totals = np.add.reduceat(weights, starts)
    counts = np.diff(np.append(starts, len(node)))
    rank = np.repeat(np.arange(len(starts)), counts)
    running_w, running_s = np.cumsum(weights), np.cumsum(sums, axis=0)
    before_w = np.where(starts > 0, running_w[starts - 1], 0)
    before_s = np.where((starts > 0)[:, None], running_s[starts - 1], 0.0)
    left_w = running_w - before_w[rank]
    right_w = totals[rank] - left_w
    left_s = running_s - before_s[rank]
    allowed = (left_w >= least) & (right_w >= max(1, least))
    inverse = 1 / np.maximum(left_w, 1) + 1 / np.maximum(right_w, 1)
    gains = np.where(allowed, (left_s * left_s).sum(axis=1) * inverse, -1.0)
    best = np.maximum.reduceat(gains, starts)
    near = np.flatnonzero(allowed & (gains >= (best - tolerance)[rank]))
    first = np.full(len(starts), -1)
    owners, places = np.unique(rank[near], return_index=True)
    first[owners] = bins[near[places]]
    return best, first


def grown(bins: np.ndarray, weights: np.ndarray, y: np.ndarray, within: np.ndarray, depth: int, least: int) -> Tree:
    """A tree of cells with at least one weight, grown level by level to pure leaves or the depth.

    ``y`` holds the means of the cells and ``within`` their squares around them.
    """
    feature, split, left, right, values = [], [], [], [], []
    rows, at, level = np.arange(len(bins)), np.zeros(len(bins), np.int64), 0
    first_node, n_nodes = 0, 1
    while n_nodes:
        w, level_y, level_bins = weights[rows], y[rows], bins[rows]
        total = np.bincount(at, w, n_nodes)
        mean = np.column_stack([np.bincount(at, w * column, n_nodes) for column in level_y.T]) / total[:, None]
        values.extend(mean)
        centred = level_y - mean[at]
        inner = within[rows]
        error = np.bincount(at, w * (centred * centred).sum(axis=1) + inner, n_nodes)
        square = np.bincount(at, w * (level_y * level_y).sum(axis=1) + inner, n_nodes)
        open_ = (error > PURE * square) & (total >= max(2, 2 * least)) & (level < depth)
        best_gain, best_feature, best_bin = np.full(n_nodes, -1.0), np.full(n_nodes, -1), np.full(n_nodes, -1)
        live = np.flatnonzero(open_[at])
        if len(live):
            weighted = centred[live] * w[live][:, None]
            for f in range(bins.shape[1]):
                key = at[live] * 65536 + level_bins[live, f]
                order = np.argsort(key, kind="stable")
                key = key[order]
                cells = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                node = key[cells] >> 16
                starts = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
                owners = node[starts]
                tolerance = EQUAL_GAIN * error[owners]
                sums = np.add.reduceat(weighted[order], cells, axis=0)
                gain, place = _best_of_feature(node, key[cells] & 65535, np.add.reduceat(w[live][order], cells), sums, starts, least, tolerance)
                better = (place >= 0) & (gain > best_gain[owners] + np.where(best_feature[owners] >= 0, tolerance, 0.0))
                best_gain[owners[better]], best_feature[owners[better]], best_bin[owners[better]] = gain[better], f, place[better]
        parents = best_feature >= 0
        children = first_node + n_nodes + 2 * (np.cumsum(parents) - 1)
        feature.extend(best_feature)
        split.extend(best_bin)
        left.extend(np.where(parents, children, -1))
        right.extend(np.where(parents, children + 1, -1))
        stay = parents[at]
        rows, at = rows[stay], at[stay]
        below = bins[rows, best_feature[at]] <= best_bin[at]
        first_node, n_nodes = first_node + n_nodes, 2 * int(parents.sum())
        at = 2 * (np.cumsum(parents) - 1)[at] + ~below
        level += 1
    return Tree(np.array(feature), np.array(split), np.array(left), np.array(right), np.array(values))


@dataclass
class _TopNode:
    """A node that passes over all rows make: its depth, weight and mean are known before it is split."""

    depth: int
    weight: float
    mean: np.ndarray
    size: float  # cells
    feature: int = -1
    bin: int = -1
    left: int = -1
    right: int = -1
    state: str = "wide"  # wide, local or done


def _top_arrays(tops: list[list[_TopNode]]) -> list[Tree]:
    return [
        Tree(*(np.array([getattr(n, name) for n in nodes]) for name in ("feature", "bin", "left", "right")), np.array([n.mean for n in nodes]))
        for nodes in tops
    ]


#: A function from the batches of a task to (tree, bins, facts) of cells; facts are weight, target sums and inner squares.
Reader = Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[int, np.ndarray, np.ndarray]]]


def _frames(batches: Iterator[pa.RecordBatch], thresholds):
    for batch in batches:
        if len(batch):
            yield batch.column("id").to_numpy(zero_copy_only=False), bins_of(rows_of(batch.column("x")), thresholds), rows_of(batch.column("y"))


def _drawn_rows(thresholds, params: ForestParameters, trees: Sequence[int]) -> Reader:
    """Every drawn row as a cell of its own."""

    def read(batches):
        for ids, bins, y in _frames(batches, thresholds):
            for tree in trees:
                w = poisson_weights(ids, tree, params.seed)
                live = np.flatnonzero(w)
                yield tree, bins[live], np.column_stack([np.ones(len(live)), y[live], np.zeros(len(live))]) * w[live][:, None]

    return read


def _stored_cells(n_features: int, n_targets: int, trees: Sequence[int]) -> Reader:
    """The cells that :func:`_cells` wrote."""
    wanted = set(trees)

    def read(batches):
        for batch in batches:
            for tree, bins, facts in zip(*(batch.column(name).to_pylist() for name in ("tree", "bins", "facts")), strict=True):
                if tree in wanted:
                    yield tree, np.frombuffer(bins, np.uint16).reshape(-1, n_features), np.frombuffer(facts).reshape(-1, n_targets + 2)

    return read


def _merged(bins: np.ndarray, facts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One cell per different row of bins, in their order; the same whatever the order in which the parts came."""
    order = np.lexsort((*facts.T, *bins.T))
    bins, facts = bins[order], facts[order]
    starts = np.flatnonzero(np.append(True, (bins[1:] != bins[:-1]).any(axis=1)))
    if len(starts) == len(bins):
        return bins, facts
    sums = np.add.reduceat(facts, starts, axis=0)
    mean = np.repeat(sums[:, 1:-1] / sums[:, :1], np.diff(np.append(starts, len(bins))), axis=0)
    off = facts[:, 1:-1] / facts[:, :1] - mean
    sums[:, -1] += np.add.reduceat(facts[:, 0] * (off * off).sum(axis=1), starts)
    return bins[starts], sums


def _packed(bins: np.ndarray) -> np.ndarray:
    """Each row of bins as one value that can be sorted."""
    words = -(-bins.shape[1] // 4)
    padded = np.zeros((len(bins), 4 * words), np.uint16)
    padded[:, : bins.shape[1]] = bins
    return padded.view(np.uint64 if words == 1 else np.dtype((np.void, 8 * words))).ravel()


def _different(thresholds):
    """Task function: the different rows of bins of each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, bins, _ in _frames(batches, thresholds):
            packed = np.unique(_packed(bins))
            raw, size = packed.tobytes(), packed.itemsize
            yield pa.RecordBatch.from_arrays([pa.array([raw[i : i + size] for i in range(0, len(raw), size)], pa.binary())], ["bins"])

    return run


def _adding(thresholds, params: ForestParameters, trees: Sequence[int], parts: int):
    """Task function: the cells of some trees, added up over the rows of the task.

    Squares are taken around the first mean seen of a cell, so that equal targets leave none. What exceeds ``pass_bytes`` is
    sent on, and counted anew.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place: dict[bytes, int] = {}
        kept, near, sums = [], None, None  # bins and first means of the cells, sums by (tree, cell)

        def sent() -> Iterator[pa.RecordBatch]:
            bins, n = np.concatenate(kept), len(place)
            part = (bins.astype(np.uint64) @ (np.arange(bins.shape[1], dtype=np.uint64) * np.uint64(2_654_435_762) + np.uint64(40_503)) >> np.uint64(7)) % np.uint64(parts)
            for number, tree in enumerate(trees):
                own = sums[number, :n].copy()
                live = own[:, 0] > 0
                own[live, -1] = np.maximum(own[live, -1] - (own[live, 1:-1] ** 2).sum(axis=1) / own[live, 0], 0.0)
                own[:, 1:-1] += own[:, :1] * near[:n]
                out = [(tree, p, int(chosen.sum()), bins[chosen].tobytes(), own[chosen].tobytes()) for p in range(parts) if (chosen := live & (part == p)).any()]
                if out:
                    columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, ["tree", "part", "n", "bins", "facts"])

        for ids, bins, y in _frames(batches, thresholds):
            packed, first, cell = np.unique(_packed(bins), return_index=True, return_inverse=True)
            n_facts = y.shape[1] + 2
            if place and (len(place) + len(packed)) * len(trees) * n_facts * 8 > params.pass_bytes:
                yield from sent()
                place, kept, near, sums = {}, [], None, None
            raw, size, old = packed.tobytes(), packed.itemsize, len(place)
            at = np.array([place.setdefault(raw[i : i + size], len(place)) for i in range(0, len(raw), size)])
            new = np.flatnonzero(at >= old)
            kept.append(bins[first[new]])
            if sums is None or len(place) > sums.shape[1]:
                grown_sums, grown_near = np.zeros((len(trees), len(place) + old, n_facts)), np.zeros((len(place) + old, y.shape[1]))
                if sums is not None:
                    grown_sums[:, :old], grown_near[:old] = sums[:, :old], near[:old]
                sums, near = grown_sums, grown_near
            counts = np.bincount(cell, minlength=len(packed))
            near[at[new]] = np.column_stack([np.bincount(cell, column, len(packed)) for column in y.T])[new] / counts[new][:, None]
            off = y - near[at[cell]]
            facts = [*np.ascontiguousarray(off.T), (off * off).sum(axis=1)]
            for number, tree in enumerate(trees):
                w = poisson_weights(ids, tree, params.seed).astype(np.float64)
                own = [np.bincount(cell, w, len(packed)), *[np.bincount(cell, w * fact, len(packed)) for fact in facts]]
                sums[number, at] += np.column_stack(own)
        if place:
            yield from sent()

    return run


def _cells(rows: DataFrame, thresholds, n: int, n_targets: int, params: ForestParameters) -> DataFrame | None:
    """The cells of all trees, written, or nothing where there are too few rows to a cell.

    A pass over the rows takes as many trees as fit ``pass_bytes``.
    """
    different = rows.select("id", "x", "y").mapInArrow(_different(thresholds), "bins binary").agg(F.approx_count_distinct("bins")).first()[0]
    at_once = params.pass_bytes // (8 * (2 + n_targets) * max(1, different))
    if n < params.fold * different or not at_once:
        return None
    size = different * (2 * len(thresholds) + 8 * (2 + n_targets))  # of one tree
    blocks = [range(begin, min(begin + at_once, params.trees)) for begin in range(0, params.trees, at_once)]
    tasks = max(4 * rows.sparkSession.sparkContext.defaultParallelism, SENT_BYTES // (size * params.trees))
    # No task sends more cells of a tree than it has rows.
    parts = max(1, -(-min(tasks * size, n * (size // max(1, different))) // PART_BYTES))
    sent = [rows.coalesce(tasks).mapInArrow(_adding(thresholds, params, block, parts), CELLS) for block in blocks]
    width = len(thresholds)

    def whole(key: tuple[Any, ...], group: pd.DataFrame) -> pd.DataFrame:
        bins = np.concatenate([np.frombuffer(b, np.uint16).reshape(-1, width) for b in group["bins"]])
        bins, facts = _merged(bins, np.concatenate([np.frombuffer(b).reshape(-1, n_targets + 2) for b in group["facts"]]))
        return pd.DataFrame([(*key, len(bins), bins.tobytes(), facts.tobytes())], columns=["tree", "part", "n", "bins", "facts"])

    return persisted(reduce(DataFrame.unionByName, sent).groupBy("tree", "part").applyInPandas(whole, CELLS))


def _summing(trees: list[Tree], wanted: dict[int, dict[int, int]], read: Reader, width: int):
    """Task function: weights, centred sums, squares and cells by (slot, feature, bin) of the nodes that the pass splits.

    ``wanted`` names, per tree, the slot of each of its nodes.
    """
    slots = sum(map(len, wanted.values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = None
        for tree, bins, cells in read(batches):
            if totals is None:
                totals = np.zeros((slots, bins.shape[1], width, cells.shape[1] + 1))
            slot_of = np.full(len(trees[tree].feature), -1)
            slot_of[list(wanted[tree])] = list(wanted[tree].values())
            leaf = trees[tree].leaves(bins)
            live = np.flatnonzero(slot_of[leaf] >= 0)
            w = cells[live, 0]
            centred = cells[live, 1:-1] / w[:, None] - trees[tree].value[leaf[live]]
            facts = np.column_stack([w, centred * w[:, None], (centred * centred).sum(axis=1) * w + cells[live, -1], np.ones(len(live))])
            for f in range(bins.shape[1]):
                cell = slot_of[leaf[live]] * width + bins[live, f]
                for column in range(facts.shape[1]):
                    totals[:, f, :, column] += np.bincount(cell, facts[:, column], slots * width).reshape(slots, width)
        if totals is not None:
            slot, f = np.nonzero(totals[..., 0].sum(axis=2))
            for begin in range(0, len(slot), 1024):
                part = slice(begin, begin + 1024)
                columns = [pa.array(slot[part], pa.int32()), pa.array(f[part], pa.int32()), lists(totals[slot[part], f[part]].reshape(len(slot[part]), -1))]
                yield pa.RecordBatch.from_arrays(columns, ["slot", "feature", "sums"])

    return run


def _splitting(width: int, least: int):
    """Task function: the best split of each (slot, feature), with weight and sums of its left side and of the node.

    Sums come around the expected mean of a node. That of a root is off, as its tree draws its rows, so all are moved to
    the mean of the drawn rows, and the node's own sums are handed back as they came.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for slot, f, sums in zip(batch["slot"], batch["feature"], batch["sums"], strict=True):
                cells = np.asarray(sums).reshape(width, -1)
                full = np.flatnonzero(cells[:, 0] > 0)
                cells, zero = cells[full], np.zeros(1, np.int64)
                node = np.zeros(len(full), np.int64)
                total = cells.sum(axis=0)
                error = total[-2] - (total[1:-2] ** 2).sum() / total[0]
                cells[:, 1:-2] -= cells[:, :1] * total[1:-2] / total[0]
                best, place = _best_of_feature(node, full, cells[:, 0], cells[:, 1:-2], zero, least, np.array([EQUAL_GAIN * error]))
                low = cells[full <= place[0]].sum(axis=0)
                rows.append((slot, f, float(best[0]), int(place[0]), float(error), low.tolist(), total.tolist()))
            yield pd.DataFrame(rows, columns=["slot", "feature", "gain", "bin", "error", "low", "total"])

    return run


def _split_wide(tops: list[list[_TopNode]], table: DataFrame, reader: Callable[[Sequence[int]], Reader], thresholds, n_targets: int, params: ForestParameters) -> None:
    """Passes over all rows or cells until no node with more than ``local_rows`` cells is left to split."""
    width = max(len(t) for t in thresholds) + 1
    at_once = max(1, params.pass_bytes // (8 * len(thresholds) * width * (3 + n_targets)))
    while True:
        wide = [(tree, number) for tree, nodes in enumerate(tops) for number, node in enumerate(nodes) if node.state == "wide"][:at_once]
        if not wide:
            return
        wanted: dict[int, dict[int, int]] = {}
        for slot, (tree, number) in enumerate(wide):
            wanted.setdefault(tree, {})[number] = slot
        partial = table.mapInArrow(_summing(_top_arrays(tops), wanted, reader(list(wanted)), width), "slot int, feature int, sums array<double>")
        sums = partial.groupBy("slot", "feature").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"))
        splits = sums.mapInPandas(_splitting(width, params.least_rows), "slot int, feature int, gain double, bin int, error double, low array<double>, total array<double>")
        found: dict[int, list] = {}
        # One row per node of the pass and feature.
        for row in sorted(splits.collect(), key=lambda r: (r["slot"], r["feature"])):
            best = found.get(row["slot"])
            if row["bin"] >= 0 and (best is None or row["gain"] > best["gain"] + EQUAL_GAIN * row["error"]):
                found[row["slot"]] = row
        for slot, (tree, number) in enumerate(wide):
            node, row = tops[tree][number], found.get(slot)
            node.state = "done"
            if row is None or row["error"] <= PURE * row["total"][0] * (1 + (node.mean**2).sum()):
                continue
            low, total = np.array(row["low"]), np.array(row["total"])
            node.mean = node.mean + total[1:-2] / total[0]
            high = np.concatenate([total[:1] - low[:1], -low[1:-2], total[-2:] - low[-2:]])
            node.feature, node.bin = row["feature"], row["bin"]
            node.left, node.right = len(tops[tree]), len(tops[tree]) + 1
            for facts in (low, high):
                child = _TopNode(node.depth + 1, facts[0], node.mean + facts[1:-2] / facts[0], facts[-1])
                if child.depth >= params.depth or child.weight < max(2, 2 * params.least_rows):
                    child.state = "done"
                elif child.size <= params.local_rows:
                    child.state = "local"
                tops[tree].append(child)


def _copying(trees: list[Tree], local: dict[int, list[int]], read: Reader):
    """Task function: the cells of each node that is finished in one task, packed per node and batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree, bins, facts in read(batches):
            leaf = trees[tree].leaves(bins)
            live = np.flatnonzero(np.isin(leaf, local[tree]))
            live = live[np.argsort(leaf[live], kind="stable")]
            out = [(tree, int(leaf[part[0]]), bins[part].tobytes(), facts[part].tobytes()) for part in np.split(live, np.flatnonzero(np.diff(leaf[live])) + 1) if len(part)]
            if out:
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["tree", "node", "bins", "facts"])

    return run


def _finishing(depths: dict[tuple[int, int], int], n_features: int, n_targets: int, params: ForestParameters):
    """Group function: the subtree of one node."""

    def run(key: tuple[Any, ...], group: pd.DataFrame) -> pd.DataFrame:
        bins = np.concatenate([np.frombuffer(b, np.uint16).reshape(-1, n_features) for b in group["bins"]])
        bins, facts = _merged(bins, np.concatenate([np.frombuffer(b).reshape(-1, n_targets + 2) for b in group["facts"]]))
        weights = facts[:, 0]
        tree = grown(bins, weights, facts[:, 1:-1] / weights[:, None], facts[:, -1], params.depth - depths[key], params.least_rows)
        row = (*key, tree.feature.tolist(), tree.split.tolist(), tree.left.tolist(), tree.right.tolist(), tree.value.ravel().tolist())
        return pd.DataFrame([row], columns=["tree", "node", "feature", "bin", "left", "right", "value"])

    return run


def _joining(trees: list[Tree], thresholds, offset: np.ndarray):
    """Group function: all subtrees of a tree hung below its top, with thresholds in place of bins."""

    def run(key: tuple[Any, ...], group: pd.DataFrame) -> pd.DataFrame:
        top = trees[key[0]]
        feature, split, left, right, value = (list(part) for part in (top.feature, top.split, top.left, top.right, top.value))
        for sub in group.sort_values("node").to_dict("records"):
            values, base = np.reshape(sub["value"], (-1, len(offset))), len(feature) - 1  # its root takes the node's place
            moved = [np.where(np.asarray(sub[side]) >= 0, np.asarray(sub[side]) + base, -1) for side in ("left", "right")]
            for column, added in zip((feature, split, left, right, value), (sub["feature"], sub["bin"], *moved, values), strict=True):
                column[sub["node"]] = added[0]
                column.extend(added[1:])
        cuts = [float(thresholds[f][b]) if f >= 0 else 0.0 for f, b in zip(feature, split, strict=True)]
        row = (key[0], [int(f) for f in feature], cuts, [int(n) for n in left], [int(n) for n in right], (np.array(value) + offset).ravel().tolist())
        return pd.DataFrame([row], columns=["tree", "feature", "threshold", "left", "right", "value"])

    return run


def candidate_thresholds(rows: DataFrame, n_features: int, bins: int) -> list[np.ndarray]:
    """Per feature the middles between neighbouring values, of at most ``bins`` + 1 values evenly spaced by rank."""
    shares = [i / bins for i in range(bins + 1)]
    columns = [F.percentile_approx(F.get("x", i), shares, 40 * bins).alias(f"f{i}") for i in range(n_features)]
    found = rows.agg(*columns).first()
    values = [np.unique(found[i]) for i in range(n_features)]
    return [(v[:-1] + v[1:]) / 2 for v in values]


def fit_trees(df: DataFrame, features: str, targets: Sequence[str], params: ForestParameters = ForestParameters()) -> DataFrame:
    """One row per tree, in the shared folder; ``features`` is a vector column. Rows without all targets are left out.

    Features and targets are read once and written, the passes and the copies of the rows read what was written.
    """
    complete = df.na.drop(subset=list(targets)).select(
        F.monotonically_increasing_id().alias("id"), vector_to_array(F.col(features)).alias("x"), F.array(*[F.col(f"`{t}`").cast("double") for t in targets]).alias("y")
    )
    rows = persisted(complete)
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width"), *[F.avg(F.get("y", i)).alias(f"m{i}") for i in range(len(targets))]).first()
    if not facts["n"]:
        raise ValueError("There are no rows with complete targets.")
    offset = np.array([facts[f"m{i}"] for i in range(len(targets))])
    rows = rows.withColumn("y", F.array(*[F.get("y", i) - F.lit(float(m)) for i, m in enumerate(offset)]))
    thresholds = candidate_thresholds(rows, facts["width"], params.bins)
    cells = _cells(rows, thresholds, facts["n"], len(targets), params)
    if cells is None:
        table, sizes = rows, {}

        def reader(wanted: Sequence[int]) -> Reader:
            return _drawn_rows(thresholds, params, wanted)
    else:
        table, sizes = cells, {r["tree"]: r["n"] for r in cells.groupBy("tree").agg(F.sum("n").alias("n")).collect()}  # one row per tree

        def reader(wanted: Sequence[int]) -> Reader:
            return _stored_cells(facts["width"], len(targets), wanted)

    tops = []
    for tree in range(params.trees):
        size = facts["n"] if cells is None else sizes.get(tree, 0)
        tops.append([_TopNode(0, float(facts["n"]), np.zeros(len(targets)), size, state="wide" if size > params.local_rows else "local")])
    _split_wide(tops, table, reader, thresholds, len(targets), params)
    trees = _top_arrays(tops)
    local = {tree: [i for i, n in enumerate(nodes) if n.state == "local"] for tree, nodes in enumerate(tops)}
    depths = {(tree, i): nodes[i].depth for tree, nodes in enumerate(tops) for i in local[tree]}
    spark = df.sparkSession
    groups = max(1, min(len(depths), 16 * spark.sparkContext.defaultParallelism, 10_000))
    copies = table.mapInArrow(_copying(trees, local, reader([t for t, nodes in local.items() if nodes])), COPIES)
    # Groups are many and alike in size; their number, not their bytes, decides on the tasks.
    copies = copies.repartition(groups, "tree", "node")
    subtrees = copies.groupBy("tree", "node").applyInPandas(_finishing(depths, facts["width"], len(targets), params), SUBTREE)
    every = spark.range(params.trees).select(F.col("id").cast("int").alias("tree"))
    # A tree that is all top, or drew no row at all, has no subtree and stays as it is.
    both = every.join(persisted(subtrees), "tree", "left").select("tree", "node", "feature", "bin", "left", "right", "value")

    def joined(key: tuple[Any, ...], group: pd.DataFrame) -> pd.DataFrame:
        return join(key, group.dropna(subset=["node"]).astype({"node": int}))

    join = _joining(trees, thresholds, offset)
    return persisted(both.groupBy("tree").applyInPandas(joined, TREE))


def _scoring(trees, n_targets: int):
    """Sum of the predictions of a block of trees; ``trees`` is broadcast."""

    def sums(x: np.ndarray) -> np.ndarray:
        total = np.zeros((len(x), n_targets))
        for tree in trees.value:
            total += tree.value[tree.leaves(x)]
        return total

    return by_distinct(sums)


def scored(df: DataFrame, features: str, trees: DataFrame, targets: Sequence[str]) -> DataFrame:
    """One column per target, the mean over all trees; the trees go out in blocks of bounded size."""
    sizes = trees.select("tree", (F.size("feature") * (24 + 8 * len(targets))).alias("bytes")).orderBy("tree").collect()  # one row per tree
    blocks, total = [[]], 0
    for row in sizes:
        if blocks[-1] and total + row["bytes"] > BLOCK_BYTES:
            blocks.append([])
            total = 0
        blocks[-1].append(row["tree"])
        total += row["bytes"]
    out, x = df, vector_to_array(F.col(features))
    for number, block in enumerate(blocks):
        held = trees.where(F.col("tree").between(block[0], block[-1])).orderBy("tree").collect()  # at most BLOCK_BYTES, or one tree
        loaded = [
            Tree(np.array(r["feature"]), np.array(r["threshold"]), np.array(r["left"]), np.array(r["right"]), np.reshape(r["value"], (-1, len(targets))))
            for r in held
        ]
        sums = _scoring(df.sparkSession.sparkContext.broadcast(loaded), len(targets))(x)
        out = out.withColumn("_sums", sums if number == 0 else F.zip_with("_sums", sums, lambda a, b: a + b))
    return out.withColumns({t: F.get("_sums", i) / len(sizes) for i, t in enumerate(targets)}).drop("_sums")
