"""N-gram Jaccard join by vertical partitioning, with the connected components of its links.

A document is its set of distinct word shingles, hashed to 64 bits. The global order of shingles is by hash, the most
frequent ones last. Documents with equal sets form a class and take part once.

1. *Candidates.* Two sets with a Jaccard similarity of at least t share a shingle among the first n - ceil(t n) + 1 of
   each. These prefixes meet by shingle; only shingles of two classes or more are kept.
2. *Counting.* The order is cut into fragments. For a candidate pair the overlap is counted in each fragment on its own
   and summed per pair, so no row holds a whole long document, and pairs at or above the threshold become links.
3. *No pair twice.* In a few rounds each class meets some other classes at each of its shingles, in an order that changes
   from round to round, first one and then four times as many each time; the pairs that share most of their prefixes are
   counted, and those of one component no longer meet. Rounds go on as long as they close a share of the meetings that a full enumeration would make, so that few
   classes are left outside of a large component. Then all pairs of classes that are still in different components are
   enumerated in full, without those that a round has counted. So a group of thousands of near copies is never expanded
   into all its pairs, and no component can be missed: every pair of a link either lies within one component already, or
   was counted in a round, or is counted at the end.

The list of frequent shingles (at most ``heavy_most``) only changes the order, thus the work and not the result. Each
task counts the shingles of distinct classes in blocks of ``heavy_block`` and reports those seen ``heavy_copies`` times
in a block, over all rows; a shingle of more classes than there are blocks is surely among them.

Defined cases: a NULL or empty text has an empty set and is linked with nothing; a text of fewer words than a shingle is
one shingle of all its words; repeated rows share a class; a NULL doc_id takes part but is never the smallest id unless all
ids of the component are NULL; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basinspark.llm.common import dropped, few_rows_at_a_time, lean, stored
from basinspark.session import broadcast_if_small


@dataclass(frozen=True)
class JoinParameters:
    words: int = 5
    percent: int = 75
    fragments: int = 4  # a power of two
    heavy_block: int = 4_000_000
    heavy_copies: int = 2
    heavy_most: int = 300_000
    rounds: int = 6  # at most, before the full enumeration
    partners: int = 3  # of a class that a round counts; from the third round on four times as many each time
    reach: int = 64  # other classes that a class meets at a shingle in a round, at most
    worth: float = 0.1  # share of the crossing meetings that a round must close to be followed by another
    few: float = 0.02  # share of the meetings; with fewer crossing ones there are no more rounds
    flushed: int = 500_000  # shingles that a task sends at a time
    known_classes: int = 500_000  # class ids that a task remembers so as to send copies once
    broadcast_rows: int = 300_000  # largest list of document ids (8 bytes each) that is broadcast


def shingles(text: str | None, seed: int, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    length = min(size, len(words))
    mixed = np.full(len(words) - length + 1, np.uint64(length * 0x51ED27 + seed), dtype=np.uint64)
    for k in range(length):
        mixed = (mixed ^ own[k : k + len(mixed)]) * np.uint64(0x9FB21C651E98DF25)
        mixed ^= mixed >> np.uint64(28)
    return np.unique(mixed)


def class_id(grams: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes()))))


def least_overlap(n: int, percent: int) -> int:
    """Shingles that a set of n shares at least with any partner."""
    return -(-n * percent // 100)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64), pa.int64())


def frequent(block: np.ndarray, copies: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that occur at least so often in a block, and how often; the block is sorted in place."""
    block.sort()
    ends = block[copies - 1 :]
    grams = np.unique(ends[block[: len(ends)] == ends])
    return grams, np.searchsorted(block, grams, side="right") - np.searchsorted(block, grams)


def _digests(seed: int, params: JoinParameters):
    """Rows (doc_id, n, node, check) of all documents, and rows (gram, copies) of shingles frequent in a block of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, known = np.empty(params.heavy_block, dtype=np.uint64), 0, set()
        names = ["doc_id", "n", "node", "check", "gram", "copies"]

        def sent() -> Iterator[pa.RecordBatch]:
            grams, copies = frequent(block[:held], params.heavy_copies)
            for k in range(0, len(grams), params.flushed):
                part = slice(k, k + params.flushed)
                n = len(grams[part])
                empty = pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays([empty, pa.nulls(n, pa.int32()), empty, empty, _signed(grams[part]), pa.array(copies[part], pa.int64())], names=names)

        for batch in batches:
            sizes, nodes, checks = [], [], []
            for text in batch.column(1):
                grams = shingles(text.as_py(), seed, params.words)
                sizes.append(len(grams))
                node = class_id(grams) if len(grams) else None
                nodes.append(node)
                checks.append(int(np.int64(np.uint64(xxhash.xxh64_intdigest(grams.tobytes(), 1)))) if len(grams) else None)
                if node not in known:
                    if len(known) >= params.known_classes:
                        known.clear()
                    known.add(node)
                    if held + len(grams) > len(block):
                        yield from sent()
                        held = 0
                    if len(grams) <= len(block):  # else a block of its own, in which no shingle occurs twice
                        block[held : held + len(grams)] = grams
                        held += len(grams)
            none = pa.nulls(len(sizes), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int32()), pa.array(nodes, pa.int64()), pa.array(checks, pa.int64()), none, none], names=names)
        yield from sent()

    return run


def in_order(grams: np.ndarray, heavy: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Shingles in the global order: by hash, the heavy ones after all others by their rank."""
    if not len(heavy) or not len(grams):
        return grams
    at = np.minimum(np.searchsorted(heavy, grams), len(heavy) - 1)
    late = heavy[at] == grams
    if not late.any():
        return grams
    return np.concatenate((grams[~late], grams[late][np.argsort(rank[at[late]], kind="stable")]))


def _prefixes(seed: int, heavy, params: JoinParameters):
    """Rows (gram, node, n, place in the order) of the prefix of each class, once for each task that has copies of it."""

    def rows(parts: list[np.ndarray], nodes: list[int], sizes: list[int]) -> pa.RecordBatch:
        lengths = [len(x) for x in parts]
        return pa.RecordBatch.from_arrays(
            [
                _signed(np.concatenate(parts)), pa.array(np.repeat(np.array(nodes, dtype=np.int64), lengths)), pa.array(np.repeat(np.array(sizes, dtype=np.int32), lengths)),
                pa.array(np.concatenate([np.arange(k, dtype=np.int32) for k in lengths])),
            ],
            names=["gram", "node", "n", "at"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        keys, rank = heavy.value
        parts, nodes, sizes, held = [], [], [], 0
        for batch in batches:
            for text in batch.column(0):
                grams = shingles(text.as_py(), seed, params.words)
                if not len(grams):
                    continue
                node = class_id(grams)
                if node in known:
                    continue
                if len(known) >= params.known_classes:
                    known.clear()
                known.add(node)
                parts.append(in_order(grams, keys, rank)[: len(grams) - least_overlap(len(grams), params.percent) + 1].copy())
                nodes.append(node)
                sizes.append(len(grams))
                held += len(parts[-1])
                if held >= params.flushed:
                    yield rows(parts, nodes, sizes)
                    parts, nodes, sizes, held = [], [], [], 0
        if parts:
            yield rows(parts, nodes, sizes)

    return run


def _fragments(seed: int, params: JoinParameters):
    """Rows (node, fragment, grams) of every text."""
    bits = params.fragments.bit_length() - 1

    def rows(nodes: list[int], numbers: list[int], parts: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array(numbers, pa.int32()), pa.array(parts, pa.list_(pa.int64()))], names=["node", "fragment", "grams"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, numbers, parts, held = [], [], [], 0
        for batch in batches:
            for text in batch.column(0):
                grams = shingles(text.as_py(), seed, params.words)
                if not len(grams):
                    continue
                node = class_id(grams)
                cuts = np.searchsorted(grams >> np.uint64(64 - bits), np.arange(params.fragments + 1, dtype=np.uint64))
                for f in range(params.fragments):
                    if cuts[f] < cuts[f + 1]:
                        nodes.append(node)
                        numbers.append(f)
                        parts.append(grams[cuts[f] : cuts[f + 1]].view(np.int64))
                held += len(grams)
                if held >= params.flushed:
                    yield rows(nodes, numbers, parts)
                    nodes, numbers, parts, held = [], [], [], 0
        if parts:
            yield rows(nodes, numbers, parts)

    return run


class NgramJoin:
    """The links of a table and its components; scratch tables live until :meth:`close`."""

    def __init__(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", params: JoinParameters = JoinParameters()):
        self.params, self.spark, self.paths = params, docs.sparkSession, []
        self.counted: list[DataFrame] = []  # pairs (a, b) that rounds have decided
        self.texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        schema = "doc_id long, n int, node long, check long, gram long, copies long"
        for self.seed in range(4):
            facts = self._stored(self.texts.mapInArrow(lean(_digests(self.seed, params)), schema), "digests")
            self.documents = facts.where("n IS NOT NULL").select("doc_id", "n", "node", "check")
            classes = self.documents.where("node IS NOT NULL").groupBy("node").agg(
                F.min("doc_id").alias("rep"), F.first("n").alias("n"), (F.min("check") != F.max("check")).alias("clash")
            )
            self.classes = self._stored(classes, "classes")
            if self.classes.where("clash").isEmpty():  # else two sets got one 64-bit id: hash anew
                break
        often = facts.where("gram IS NOT NULL").groupBy("gram").agg(F.sum("copies").alias("copies"))
        rows = often.orderBy(F.desc("copies"), "gram").limit(params.heavy_most).toArrow()
        keys = rows["gram"].to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(keys)
        self.heavy = self.spark.sparkContext.broadcast((keys[order], len(keys) - order))

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        table, path = stored(df, name)
        self.paths.append(path)
        return table

    def close(self) -> None:
        self._drop(self.paths)

    def _drop(self, paths: list[str]) -> None:
        """Delete tables that no later step reads."""
        dropped(self.spark, *paths)
        self.paths = [p for p in self.paths if p not in set(paths)]

    def meetings(self) -> DataFrame:
        """Prefix shingles that at least two classes share: a row per shingle and class."""
        entries = self.texts.select("text").mapInArrow(lean(_prefixes(self.seed, self.heavy, self.params)), "gram long, node long, n int, at int")
        ordered = Window.partitionBy("gram").orderBy("node")
        last = F.last("node").over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        seen = entries.withColumns({"prev": F.lag("node").over(ordered), "first": F.first("node").over(ordered), "last": last})
        shared = seen.where("first <> last AND (prev IS NULL OR prev <> node)")
        return self._stored(shared.select("gram", "node", "n", "at"), "meetings")

    def room(self, n_x: Column, at_x: Column, n_y: Column, at_y: Column) -> Column:
        """Whether two sets can reach the threshold if a shingle at these places is the first one that they share.

        Behind a shared shingle at places i and j at most min(n_x - i, n_y - j) are shared, itself included. The first one
        that a linked pair shares leaves room for the overlap that it needs.
        """
        p = self.params.percent
        return (100 + p) * F.least(n_x - at_x, n_y - at_y) >= p * (n_x + n_y)

    def open_meetings(self, meetings: DataFrame, labels: DataFrame | None) -> DataFrame:
        """Meetings with the component of each class, without the shingles whose classes are all in one component."""
        if labels is None:
            return meetings.withColumn("component", F.col("node"))
        named = meetings.drop("component").join(broadcast_if_small(labels), "node", "left").withColumn("component", F.coalesce("component", "node"))
        within = Window.partitionBy("gram")
        ends = named.withColumns({"low": F.min("component").over(within), "high": F.max("component").over(within)})
        return self._stored(ends.where("low <> high").drop("low", "high"), "open")

    def early(self) -> Column:
        """Whether a shingle's place has room for a partner of the same size at the same place."""
        return self.room(F.col("n"), F.col("at"), F.col("n"), F.col("at"))

    def crossing(self, open_: DataFrame) -> int:
        """Meetings of classes of different components at their early shingles, if all were enumerated."""
        sizes = open_.where(self.early()).groupBy("gram", "component").agg(F.count("*").cast("decimal(19,0)").alias("k"))
        grams = sizes.groupBy("gram").agg(F.sum("k").alias("n"), F.sum(F.col("k") * F.col("k")).alias("own"))
        return int(grams.agg(F.sum(F.col("n") * F.col("n") - F.col("own"))).first()[0] or 0) // 2

    def enough(self, shared: Column, n_a: Column, n_b: Column) -> Column:
        """Whether two sets that share so much of their prefixes can reach the threshold.

        Beyond the prefix that ends first in the order lie at most ceil(t n) - 1 shared shingles.
        """
        p = self.params.percent
        beyond = F.ceil(p * F.greatest(n_a, n_b) / 100) - 1
        return (100 + p) * (shared + beyond) >= p * (n_a + n_b)

    def round_pairs(self, open_: DataFrame, prefixes: DataFrame, number: int) -> DataFrame:
        """For each class some others of different components that it meets, those that share most of its prefix."""
        dealt = Window.partitionBy("gram").orderBy(F.xxhash64(F.lit(number), "gram", "node"), "node")
        before = F.collect_list(F.struct("node", "n", "at", "component")).over(dealt.rowsBetween(-min(4**number, self.params.reach), -1))
        apart = F.filter(before, lambda y: (y["component"] != F.col("component")) & self.room(F.col("n"), F.col("at"), y["n"], y["at"]))
        met = open_.where(self.early()).select("node", "n", apart.alias("prev")).withColumn("prev", F.explode("prev"))
        pairs = self.uncounted(self.pairs(met.select(F.struct("n", "node").alias("x"), F.col("prev").alias("y"))))
        hopeful = self.enough(F.col("shared"), F.col("n_a"), F.col("n_b"))
        best = [F.row_number().over(Window.partitionBy(x, hopeful).orderBy(F.desc("shared"), y)) for x, y in (("b", "a"), ("a", "b"))]
        # Later on few classes meet a large component, so that each of them has many partners and these have few.
        place = F.greatest(*best) if number else best[0]
        # A pair out of reach has no place; one beyond the last place stays for another round or the enumeration.
        ranked = self._stored(self.shared(pairs, prefixes).withColumn("place", F.when(hopeful, place)), "ranked")
        chosen = F.col("place") <= self.params.partners * 4 ** max(0, number - 1)
        self.counted.append(ranked.where(F.col("place").isNull() | chosen).select("a", "b"))
        return ranked.where(chosen).drop("place", "shared")

    def uncounted(self, pairs: DataFrame) -> DataFrame:
        """Pairs that no round has decided."""
        for known in self.counted:
            pairs = pairs.join(known, ["a", "b"], "left_anti")
        return pairs

    def shared(self, pairs: DataFrame, prefixes: DataFrame) -> DataFrame:
        """Pairs with what they share of their prefixes."""
        pairs = self._stored(pairs, "met")
        both = prefixes.select(F.col("node").alias("a"), F.col("grams").alias("x")).join(broadcast_if_small(pairs), "a")
        both = both.join(prefixes.select(F.col("node").alias("b"), F.col("grams").alias("y")), "b")
        return both.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("x", "y")).alias("shared"))

    @staticmethod
    def pairs(found: DataFrame) -> DataFrame:
        small, large = F.least("x.node", "y.node"), F.greatest("x.node", "y.node")
        n_of = lambda node: F.when(F.col("x.node") == node, F.col("x.n")).otherwise(F.col("y.n"))
        return found.select(small.alias("a"), large.alias("b"), n_of(small).alias("n_a"), n_of(large).alias("n_b")).distinct()

    def linked(self, pairs: DataFrame) -> DataFrame:
        """Pairs at or above the threshold, by overlaps counted per fragment and summed."""
        p, before = self.params, len(self.paths)
        pairs = self._stored(pairs, "pairs")
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = self._stored(nodes.join(self.classes, "node").select("rep").distinct(), "wanted")
        few = wanted.limit(p.broadcast_rows + 1).count() <= p.broadcast_rows
        side = F.broadcast(wanted) if few else wanted
        texts = self.texts.join(side, self.texts["doc_id"].eqNullSafe(side["rep"]), "left_semi").select("text")
        parts = self._stored(texts.mapInArrow(lean(_fragments(self.seed, p)), "node long, fragment int, grams array<long>"), "fragments")
        left = parts.select(F.col("node").alias("a"), "fragment", F.col("grams").alias("x")).join(broadcast_if_small(pairs), "a")
        both = left.join(parts.select(F.col("node").alias("b"), "fragment", F.col("grams").alias("y")), ["b", "fragment"])
        partial = both.select("a", "b", "n_a", "n_b", "fragment", F.size(F.array_intersect("x", "y")).alias("shared"))
        partial = partial.groupBy("a", "b", "n_a", "n_b", "fragment").agg(F.max("shared").alias("shared"))  # repeated rows
        total = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("shared").alias("shared"))
        reached = (100 + p.percent) * F.col("shared") >= p.percent * (F.col("n_a") + F.col("n_b"))
        links = self._stored(total.where(reached).select("a", "b"), "links")
        self._drop(self.paths[before:-1])
        return links

    def components(self, edges: DataFrame) -> DataFrame:
        """(node, component) of every node of an edge: least labels of neighbours, and labels of labels, until stable."""
        before = len(self.paths)
        both = self._stored(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
        labels = self._stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("component")), "labels")
        while True:
            around = both.join(labels.withColumnsRenamed({"node": "b", "component": "near"}), "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
            nearer = labels.join(around, "node").select("node", F.least("component", "near").alias("next"), "component")
            jumped = nearer.join(labels.withColumnsRenamed({"node": "next", "component": "far"}), "next").select("node", F.least("next", "far").alias("component"), F.col("component").alias("old"))
            step = self._stored(jumped, "labels")
            labels = step.select("node", "component")
            if step.where("component <> old").isEmpty():
                self._drop(self.paths[before:-1])
                return labels

    def all_pairs(self, open_: DataFrame, prefixes: DataFrame) -> DataFrame:
        """All pairs of different components that share enough of their prefixes, but for those that rounds have decided.

        Only meetings with room become rows, see :meth:`room`.
        """
        p = self.params.percent
        x, y = open_.alias("x"), open_.alias("y")
        on = (F.col("x.gram") == F.col("y.gram")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.component") != F.col("y.component"))
        met = x.join(y, on & self.room(F.col("x.n"), F.col("x.at"), F.col("y.n"), F.col("y.at")))
        # The meetings with room are the first ones of a pair, so behind the last of them the rest is known.
        facts = met.groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.col("x.n").alias("n_a"), F.col("y.n").alias("n_b"))
        facts = facts.agg(F.count("*").alias("k"), F.max("x.at").alias("i"), F.max("y.at").alias("j"))
        most = F.col("k") + F.least(F.col("n_a") - F.col("i"), F.col("n_b") - F.col("j")) - 1
        pairs = facts.where((100 + p) * most >= p * (F.col("n_a") + F.col("n_b"))).select("a", "b", "n_a", "n_b")
        found = self.shared(self.uncounted(pairs), prefixes)
        return found.where(self.enough(F.col("shared"), F.col("n_a"), F.col("n_b"))).drop("shared")

    def merged(self, labels: DataFrame | None, links: DataFrame) -> DataFrame:
        """Components after more links between classes of different components."""
        if labels is None:
            return self.components(links)
        joined = links
        for side in ("a", "b"):
            joined = joined.join(labels.select(F.col("node").alias(side), F.col("component").alias(f"{side}_component")), side, "left")
        between = joined.select(F.coalesce("a_component", "a").alias("a"), F.coalesce("b_component", "b").alias("b")).where("a <> b").distinct()
        moved = self.components(between).select(F.col("node").alias("component"), F.col("component").alias("moved"))
        # a class without a link so far is its own component, so it is among the moved ones
        alone = moved.select(F.col("component").alias("node"), "component").join(labels, "node", "left_anti")
        every = labels.unionByName(alone).join(moved, "component", "left")
        return self._stored(every.select("node", F.coalesce("moved", "component").alias("component")), "labels")

    def members(self) -> DataFrame:
        """(doc_id, n_shingles, class_id, component_id) of every document."""
        meetings = self.meetings()
        prefixes = self._stored(meetings.groupBy("node").agg(F.collect_list("gram").alias("grams")), "prefixes")
        open_, labels, size, before = self.open_meetings(meetings, None), None, meetings.count(), None
        for number in range(self.params.rounds):
            left = self.crossing(open_)
            if before is not None and (left <= self.params.few * size or left > (1 - self.params.worth) * before):
                break
            links, before = self.linked(self.round_pairs(open_, prefixes, number)), left
            if links.isEmpty():
                break
            labels = self.merged(labels, links)
            open_ = self.open_meetings(open_, labels)
        if labels is None:
            labels = self.spark.createDataFrame([], "node long, component long")
        labels = self.merged(labels, self.linked(self.all_pairs(open_, prefixes)))
        top = self.classes.select("node", "rep").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        least = top.groupBy("component").agg(F.min("rep").alias("component_id"))
        ids = top.join(least, "component").select("node", F.col("rep").alias("class_id"), "component_id")
        rows = self.documents.join(ids, "node", "left")
        alone = F.col("node").isNull()
        return rows.select(
            "doc_id", F.col("n").cast("long").alias("n_shingles"),
            F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
            F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        )


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", params: JoinParameters = JoinParameters()) -> DataFrame:
    """One row per document: size of its set, smallest id with the same set, smallest id reachable by links.

    The join runs when this is called, as its second round depends on the first; the result is a written table.
    """
    with few_rows_at_a_time(docs.sparkSession):
        join = NgramJoin(docs, doc_id, text, params)
        try:
            return stored(join.members(), "members")[0]
        finally:
            join.close()
