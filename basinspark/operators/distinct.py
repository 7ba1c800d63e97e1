"""Row-wise computations in tasks that work once on rows that occur again.

The functions that tasks run are nested, so they go to the tasks whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

#: Most different rows whose results one task keeps.
KEPT_ROWS = 100_000


def rows_of(column: pa.Array) -> np.ndarray:
    """A column of arrays of equal length, none of them NULL, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def lists(values: np.ndarray) -> pa.Array:
    """A matrix as a column of arrays."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32()), pa.array(values.ravel(), pa.float64()))


def by_distinct(compute: Callable[[np.ndarray], np.ndarray], most: int | None = None):
    """A function of columns of arrays that gives the rows of ``compute`` and calls it once per different row.

    A task keeps the results of the first ``most`` different rows it meets. Batches that hardly repeat a row are computed
    as they are.
    """
    most = KEPT_ROWS if most is None else most

    @F.arrow_udf("array<double>")
    def results(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def listed(values):
            return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32()), pa.array(values.ravel(), pa.float64()))

        place, kept = {}, None
        for batch in batches:
            if not len(batch):
                yield pa.array([], pa.list_(pa.float64()))
                continue
            x = np.ascontiguousarray(batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1))
            size = x.shape[1] * 8
            packed, first, own = np.unique(x.view(np.dtype((np.void, size))).ravel(), return_index=True, return_inverse=True)
            if len(packed) > 0.9 * len(x):
                yield listed(compute(x))
                continue
            raw = packed.tobytes()
            keys = [raw[i : i + size] for i in range(0, len(raw), size)]
            at = np.array([place.get(key, -1) for key in keys])
            new = np.flatnonzero(at < 0)
            fresh = compute(x[first[new]]) if len(new) or kept is None else kept[:0]
            out = np.empty((len(packed), fresh.shape[1]))
            out[new] = fresh
            if kept is not None:
                out[at >= 0] = kept[at[at >= 0]]
            if len(new) and len(place) + len(new) <= most:
                place.update({keys[i]: len(place) + n for n, i in enumerate(new)})
                kept = fresh if kept is None else np.concatenate([kept, fresh])
            elif kept is None:
                kept = fresh[:0]
            yield listed(out[own])

    return results
