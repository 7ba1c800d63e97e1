"""Which runs are complete, as their values arrive.

A run is expected to have a fixed number of distinct values. The state of a run is the set of those seen, as the bits of one
number per 64 values. It is released as soon as it is full; a run that is still incomplete when the watermark passes its
time plus the delay is reported late, with the number of values it has. Values that arrive again change nothing, before and
after the release: a released run is remembered until its time has passed.

Runs are independent keys, so a large number of them is spread over all tasks, and the state of a run is a few numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

REPORT = "run long, status string, n_values int"
STATE = "seen array<long>, released boolean, due long"


def _followed(expected: int, delay_ms: int):
    """Group function: the report of a run, at most one in all."""

    def run(key: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, released, due = state.get if state.exists else ([0] * (-(-expected // 64)), False, 0)
        seen = list(seen)
        if state.hasTimedOut:
            state.remove()
            if not released:
                yield pd.DataFrame([(key[0], "late", sum(bin(word & 0xFFFFFFFFFFFFFFFF).count("1") for word in seen))], columns=["run", "status", "n_values"])
            return
        new = not state.exists
        for batch in batches:
            for number in batch["number"].unique():
                word = seen[int(number) // 64] & 0xFFFFFFFFFFFFFFFF | 1 << int(number) % 64
                seen[int(number) // 64] = word - (1 << 64) if word >> 63 else word  # as a signed long
            due = max(due, int(batch["time"].max().timestamp() * 1000) + delay_ms)
        if new and due <= state.getCurrentWatermarkMs():
            return  # all of it is over, so these values came too late
        full = sum(bin(word & 0xFFFFFFFFFFFFFFFF).count("1") for word in seen) == expected
        if full and not released:
            released = True
            yield pd.DataFrame([(key[0], "complete", expected)], columns=["run", "status", "n_values"])
        state.update((seen, released, due))
        state.setTimeoutTimestamp(due)

    return run


def followed_runs(values: DataFrame, expected: int, delay: str = "1 day", run: str = "run", time: str = "run_ts", number: str = "number") -> DataFrame:
    """Report of the runs of a stream: ``complete`` with all its values, or ``late`` with as many as came in time.

    ``number`` tells the values of a run apart, from 0 to ``expected`` - 1; ``time`` is the time of the run, the same for
    all its values. Rows of a time that the watermark has passed no longer count. Use output mode append.
    """
    delay_ms = int(pd.Timedelta(delay).total_seconds() * 1000)
    keyed = values.select(F.col(run).cast("long").alias("run"), F.col(time).cast("timestamp").alias("time"), F.col(number).cast("int").alias("number"))
    known = keyed.where("run IS NOT NULL AND time IS NOT NULL").where(F.col("number").between(0, expected - 1))
    return known.withWatermark("time", delay).groupBy("run").applyInPandasWithState(_followed(expected, delay_ms), REPORT, STATE, "append", GroupStateTimeout.EventTimeTimeout)
