"""Mixing sources to target weights by a min-cost flow over membership patterns.

Documents are aggregated by the set of sources they belong to (their pattern). On that small graph each pattern offers
its words once for nothing, and once more for each further repetition at a rising cost; arcs lead from a pattern to its
sources, and from each source to its quota. The cheapest flow says how many words each pattern gives. Documents of a
pattern are then taken in a seeded order until that amount is reached; the last one is taken in part.

Patterns and sources are tables, whatever their number. Targets follow from a few passes over the sources. A pattern of one
source that shares it with no other kind of pattern needs no flow: it gives what its source asks for. All others fall into
groups that share sources; each group's flow is solved by one task. Prefix sums over a pattern run in two levels (a bucket
of the seeded hash, then inside it), so a pattern with a third of all rows is spread over as many buckets as it needs.

Defined cases: a NULL or empty text has size 0 and gives nothing; a document without sources forms a source of its
own, named NULL; rows that repeat are separate documents; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import defaultdict, deque
from collections.abc import Mapping, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basinspark.llm.common import dropped, stored
from basinspark.operators.positions import with_position
from basinspark.session import broadcast_if_small

#: Rows that a bucket of the seeded hash holds, about; a pattern has 16 ** digits of them, three digits at least.
BUCKET_ROWS = 50_000


def leveled(sources: DataFrame, weights: Sequence[float], total: float, most: int) -> DataFrame:
    """Targets of the sources (``source``, ``source_size``): shares of ``total`` by weight, at most ``most`` times the size.

    Weights repeat over the sources in code point order, NULL last. The excess of a full source is given on by weight: a
    target is ``min(cap, level x weight)`` for the level at which all add up to the total. Starting from the level without
    caps, each pass takes the sources that are full out; the level rises until none is added, within a few passes.
    """
    ordered = with_position(sources.withColumn("_last", F.col("source").isNull()), ["_last", "source"], "_place").drop("_last")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    ranked, _ = stored(ordered.withColumns({"_weight": weight, "_cap": F.col("source_size") * most}).drop("_place"), "sources")
    level = None
    while True:
        full = F.lit(False) if level is None else F.lit(level) * F.col("_weight") > F.col("_cap")
        sums = ranked.agg(F.sum(F.when(full, F.col("_cap")).otherwise(0)).alias("caps"), F.sum(F.when(full, 0.0).otherwise(F.col("_weight"))).alias("open")).first()
        found = (total - sums["caps"]) / sums["open"] if sums["open"] else None
        if found is None or found == level:
            break
        level = found
    share = F.col("_cap").cast("double") if level is None or found is None else F.least(F.col("_cap").cast("double"), F.lit(level) * F.col("_weight"))
    return ranked.select("source", "source_size", share.alias("target"))


def cheapest_flow(offers: Mapping[int, tuple[int, Sequence[int]]], quotas: Sequence[int], costs: Sequence[int]) -> dict[tuple[int, int], int]:
    """Words from each pattern to each of its sources, as (pattern, source index) -> words.

    ``offers`` maps a pattern to its words and its source indices; ``costs`` has the cost of each repetition, rising.
    Successive shortest paths; arcs of the residual graph are searched with a queue (costs can be negative there).
    """
    start, end = ("start",), ("end",)
    arcs: list[list] = []  # [from, to, room, cost]; arc i ^ 1 is its reverse
    out: dict[tuple, list[int]] = defaultdict(list)

    def add(a: tuple, b: tuple, room: int, cost: int) -> None:
        out[a].append(len(arcs))
        arcs.append([a, b, room, cost])
        out[b].append(len(arcs))
        arcs.append([b, a, 0, -cost])

    for p, (words, members) in sorted(offers.items()):
        for cost in costs:
            add(start, ("pattern", p), words, cost)
        for s in members:
            add(("pattern", p), ("source", s), words * len(costs), 0)
    for s, quota in enumerate(quotas):
        add(("source", s), end, quota, 0)
    while True:
        cost_to, by, queue, waiting = {start: 0}, {}, deque([start]), {start}
        while queue:
            node = queue.popleft()
            waiting.discard(node)
            for i in out[node]:
                _, to, room, cost = arcs[i]
                if room > 0 and cost_to[node] + cost < cost_to.get(to, math.inf):
                    cost_to[to], by[to] = cost_to[node] + cost, i
                    if to not in waiting:
                        waiting.add(to)
                        queue.append(to)
        if end not in cost_to:
            break
        path, node = [], end
        while node != start:
            path.append(by[node])
            node = arcs[by[node]][0]
        amount = min(arcs[i][2] for i in path)
        for i in path:
            arcs[i][2] -= amount
            arcs[i ^ 1][2] += amount
    return {
        (a[1], b[1]): arcs[i ^ 1][2] for i, (a, b, _, _) in enumerate(arcs) if i % 2 == 0 and a[0] == "pattern" and arcs[i ^ 1][2] > 0
    }


def _groups(members: DataFrame) -> DataFrame:
    """A group number for each pattern (``_pattern``), the same for all that share a source, directly or through others.

    Each round gives a pattern the least number among the patterns of its sources, until nothing changes.
    """
    numbers = members.select("_pattern", "source", F.col("_pattern").alias("_group"))
    numbers, path = stored(numbers, "groups")
    while True:
        by_source = numbers.groupBy("source").agg(F.min("_group").alias("_low"))
        near = numbers.join(by_source, numbers["source"].eqNullSafe(by_source["source"])).groupBy("_pattern").agg(F.min("_low").alias("_least"))
        moved, next_path = stored(numbers.join(near, "_pattern").select("_pattern", "source", F.col("_least").alias("_group"), (F.col("_least") < F.col("_group")).alias("_moved")), "groups")
        changed = not moved.where("_moved").isEmpty()
        dropped(members.sparkSession, path)
        numbers, path = moved.drop("_moved"), next_path
        if not changed:
            return numbers.select("_pattern", "_group").distinct()


def _flowing(most: int):
    """Group function: the words that each pattern of a group gives."""

    def run(key: tuple[Any, ...], group: pd.DataFrame) -> pd.DataFrame:
        rows = group.assign(name=[(s is None, s or "") for s in group["source"]]).sort_values(["name", "_pattern"])
        names = list(dict.fromkeys(rows["name"]))
        place = {name: i for i, name in enumerate(names)}
        quota = {name: math.floor(t + 1e-6) for name, t in zip(rows["name"], rows["target"], strict=True)}
        members = {p: (int(part["words"].iloc[0]), [place[n] for n in part["name"]]) for p, part in rows.groupby("_pattern")}
        order = sorted(members, key=lambda p: (members[p][1], p))
        flow = cheapest_flow({i: members[p] for i, p in enumerate(order)}, [quota[n] for n in names], [k * k for k in range(most)])
        given = [sum(flow.get((i, s), 0) for s in members[p][1]) for i, p in enumerate(order)]
        return pd.DataFrame({"_pattern": order, "_amount": given})

    return run


def mixed(
    docs: DataFrame, doc_id: str, size: Column, sources: Column, weights: Sequence[float] = (3, 1, 2), total_share: float = 1.5, most: int = 2, seed: str = "mix"
) -> DataFrame:
    """One row per document: ``size``, ``sources`` (sorted), ``source_size`` and ``target`` of its first source, ``taken``.

    ``sources`` is an array of source names; ``weights`` repeat over them. ``most`` is how often a document may be taken
    at most and how far above its size a target may rise.
    """
    named = F.array_sort(F.array_distinct(F.coalesce(sources, F.array(F.lit(None).cast("string")))))
    named = F.when(F.size(named) == 0, F.array(F.lit(None).cast("string"))).otherwise(named)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(size, F.lit(0)).cast("long").alias("size"), named.alias("sources"))
    rows = rows.withColumns({"_order": F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), "_pattern": F.xxhash64("sources")})

    patterns = rows.groupBy("sources", "_pattern").agg(F.sum("size").alias("words"), F.count("*").alias("_rows"))
    patterns, _ = stored(patterns, "patterns")
    facts = patterns.agg(F.sum("words").alias("words"), F.max("_rows").alias("most"), F.max(F.size("sources")).alias("width")).first()
    members = patterns.select("_pattern", "words", F.size("sources").alias("_width"), F.explode("sources").alias("source"))
    sizes = members.groupBy("source").agg(F.sum("words").alias("source_size"), F.max("_width").alias("_width"))
    targets, _ = stored(leveled(sizes, weights, total_share * (facts["words"] or 0), most), "targets")
    side = broadcast_if_small(targets.select(F.col("source").alias("_source"), "source_size", "target"))
    plan = patterns.join(side, F.col("sources")[0].eqNullSafe(F.col("_source"))).select("_pattern", F.col("words").alias("_words"), "source_size", "target")
    alone = F.least(F.floor(F.col("target") + 1e-6), F.col("_words") * most).cast("long")
    if (facts["width"] or 1) > 1:
        shared = members.groupBy("source").agg(F.max("_width").alias("_most")).where("_most > 1").select(F.col("source").alias("_shared"))
        linked, _ = stored(members.join(shared, F.col("source").eqNullSafe(F.col("_shared"))).drop("_shared"), "linked")
        grouped = linked.join(_groups(linked), "_pattern").join(side, F.col("source").eqNullSafe(F.col("_source")))
        flows = grouped.select("_group", "_pattern", "words", "source", "target").groupBy("_group").applyInPandas(_flowing(most), "_pattern long, _amount long")
        plan = plan.join(flows, "_pattern", "left").withColumn("_amount", F.coalesce("_amount", alone))
    else:
        plan = plan.withColumn("_amount", alone)
    plan, _ = stored(plan, "plan")

    digits = max(3, math.ceil(math.log((facts["most"] or 1) / BUCKET_ROWS, 16)))
    rows = rows.withColumn("_bucket", F.substring("_order", 1, digits))
    sums = rows.groupBy("_pattern", "_bucket").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("_pattern").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("_pattern", "_bucket", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_pattern", "_bucket").orderBy("_order", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(before, ["_pattern", "_bucket"]).join(broadcast_if_small(plan), "_pattern")

    position = F.col("_before") + F.col("_inside")
    taken = F.lit(0).cast("long")
    for k in range(most):
        room = F.col("_amount") - k * F.col("_words") - position
        taken = taken + F.greatest(F.lit(0), F.least(room, F.col("size")))
    return placed.select("doc_id", "size", "sources", "source_size", "target", taken.cast("long").alias("taken"))
