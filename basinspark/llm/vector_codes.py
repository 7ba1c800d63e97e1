"""Product quantisation of integer vectors by exact matrix products.

Components become integers, vectors are cut into equal parts, and every part is coded by the nearest entry of the codebook
of its position. Distances are exact: each integer is split into limbs narrow enough that a float64 matrix product of two
limb matrices stays below 2**53, the products are shifted and added in int64, and the first smallest distance wins.

Each round is one pass over the vectors; a task adds up its own parts, so only entries times components rows leave it,
whatever the number of vectors. The codebooks, bounded by entries and components, are all that reaches the driver.

Defined cases: rows with a NULL vector, a NULL or a non-finite component, or no component are left out. So are vectors
whose length differs from that of the first kept one (by id, NULL last), as no codebook fits them. A length that the
parts do not divide is filled up with zeros. With fewer vectors than entries the codebooks are that much smaller. Rows may
repeat: equal ids are ordered by their vector. Integers so large that a vector's squared distance could leave the range of
a long (beyond 2**27 with 64 components) are an error that says so. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basinspark.llm.common import stored
from basinspark.session import broadcast_if_small

#: Integers that a float64 holds exactly.
EXACT_BITS = 53
#: Vectors whose distances to all entries are held at once.
BLOCK = 4096


@dataclass(frozen=True)
class CodeParameters:
    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256


def limbs(values: np.ndarray, width: int) -> list[np.ndarray]:
    """int64 values as float64 limbs: all but the last in [0, 2**width), the last one signed."""
    found, rest = [], values
    while rest.size and max(int(rest.max()), -int(rest.min()) - 1) >> width:
        found.append((rest & ((1 << width) - 1)).astype(np.float64))
        rest = rest >> width
    return [*found, rest.astype(np.float64)]


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``left @ right.T`` of int64 matrices in int64, by float64 products that are exact.

    With limbs of ``width`` bits and ``n`` columns no partial sum reaches ``n * 2**(2 * width) <= 2**53``. The result is
    right whenever it fits an int64.
    """
    width = (EXACT_BITS - max(1, left.shape[1] - 1).bit_length()) // 2
    total = np.zeros((len(left), len(right)), np.int64)
    lefts, rights = limbs(left, width), limbs(right, width)
    for i, a in enumerate(lefts):
        for j, b in enumerate(rights):
            total += (a @ b.T).astype(np.int64) << (width * (i + j))
    return total


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For int64 rows the first nearest entry, and its squared distance."""
    codes, errors = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
    lengths = (entries * entries).sum(axis=1)
    for begin in range(0, len(parts), BLOCK):
        block = parts[begin : begin + BLOCK]
        gains = lengths - 2 * exact_products(block, entries)
        best = gains.argmin(axis=1)
        codes[begin : begin + BLOCK] = best
        errors[begin : begin + BLOCK] = gains[np.arange(len(block)), best] + (block * block).sum(axis=1)
    return codes, errors


def integer_vectors(column: pa.Array, length: int, params: CodeParameters) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are kept, and their integers with zeros up to a multiple of the parts."""
    offsets = np.asarray(column.offsets, dtype=np.int64)
    values = column.values
    sizes = offsets[1:] - offsets[:-1]
    bad = np.zeros(len(values) + 1, np.int64)
    numbers = np.zeros(0)
    if len(values):
        present = ~np.asarray(values.is_null())
        numbers = np.asarray(values.cast(pa.float64()).fill_null(0.0))
        np.cumsum(~(present & np.isfinite(numbers)), out=bad[1:])
    kept = np.asarray(column.is_valid()) & (sizes == length) & (bad[offsets[1:]] == bad[offsets[:-1]])
    rows = np.flatnonzero(kept)
    if not len(rows):
        return rows, np.zeros((0, length + -length % params.parts), np.int64)
    scaled = np.floor(params.scale * numbers[offsets[rows][:, None] + np.arange(length)])
    most = math.isqrt((1 << 63) // (4 * length)) - 1
    if np.abs(scaled).max() > most:
        raise ValueError(f"A component times {params.scale} is beyond {most}: squared distances could leave the range of a long.")
    return rows, np.pad(scaled.astype(np.int64), ((0, 0), (0, -length % params.parts)))


def _first_length(vectors: DataFrame, params: CodeParameters) -> tuple[int, np.ndarray]:
    """Length of the first kept vector, and the integers of the first ones of this length."""
    vector = F.col("vector")
    sound = F.coalesce(F.size(vector) > 0, F.lit(False)) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ordered = vectors.where(sound)
    order = [F.col("vec_id").asc_nulls_last(), F.col("vector")]
    head = ordered.orderBy(*order).select(F.size(vector)).first()
    if head is None:
        return 0, np.zeros((0, 0), np.int64)
    # As many rows as a codebook has entries.
    first = ordered.where(F.size(vector) == head[0]).orderBy(*order).limit(params.entries).select(vector).collect()
    column = pa.array([r["vector"] for r in first], pa.list_(pa.float64()))
    return head[0], integer_vectors(column, head[0], params)[1]


def _summing(codebooks: np.ndarray, length: int, params: CodeParameters):
    """Task function: sums and counts of the parts that each entry is nearest to, for all rows of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_parts, n_entries, width = codebooks.shape
        sums, counts = np.zeros(codebooks.shape, np.int64), np.zeros((n_parts, n_entries), np.int64)
        for batch in batches:
            _, integers = integer_vectors(batch.column(0), length, params)
            for part in range(n_parts):
                rows = integers[:, part * width : (part + 1) * width]
                codes, _ = nearest(rows, codebooks[part])
                np.add.at(sums[part], codes, rows)
                counts[part] += np.bincount(codes, minlength=n_entries)
        part, entry = np.nonzero(counts)
        place = np.tile(np.arange(width), len(part))
        part, entry = np.repeat(part, width), np.repeat(entry, width)
        columns = (part, entry, place, sums[part, entry, place], counts[part, entry])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["part", "entry", "place", "total", "n"])

    return run


def refined(vectors: DataFrame, codebooks: np.ndarray, length: int, params: CodeParameters) -> np.ndarray:
    """Codebooks after one round: entries become the floor of the mean of their parts; unused ones stay."""
    partial = vectors.select("vector").mapInArrow(_summing(codebooks, length, params), "part long, entry long, place long, total long, n long")
    sums = partial.groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    found = codebooks.copy()
    # As many rows as the codebooks have numbers.
    for row in sums.collect():
        found[row["part"], row["entry"], row["place"]] = int(row["total"]) // row["n"]
    return found


def _coding(codebooks: np.ndarray, length: int, params: CodeParameters):
    """Task function: codes and errors of the kept rows; the vector is the last column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_parts, _, width = codebooks.shape
        for batch in batches:
            rows, integers = integer_vectors(batch.column(batch.num_columns - 1), length, params)
            codes, errors = np.zeros((len(rows), n_parts), np.uint8 if codebooks.shape[1] <= 256 else np.uint16), np.zeros(len(rows), np.int64)
            for part in range(n_parts):
                found, distances = nearest(integers[:, part * width : (part + 1) * width], codebooks[part])
                codes[:, part] = found
                errors += distances
            digits = codes.astype(codes.dtype.newbyteorder(">"))
            kept = [c.take(pa.array(rows)) for c in batch.columns[:-1]]
            texts = pa.array([r.tobytes().hex() for r in digits], pa.string())
            yield pa.RecordBatch.from_arrays([*kept, texts, pa.array(errors, pa.int64())], names=[*batch.schema.names[:-1], "code", "error"])

    return run


def learned(vectors: DataFrame, params: CodeParameters = CodeParameters()) -> tuple[int, np.ndarray]:
    """Length of the vectors, and codebooks by part, entry and position, of the columns ``vec_id`` and ``vector``."""
    length, first = _first_length(vectors, params)
    codebooks = first.reshape(len(first), params.parts, -1).transpose(1, 0, 2).copy() if length else np.zeros((params.parts, 0, 0), np.int64)
    for _ in range(params.rounds if length else 0):
        codebooks = refined(vectors, codebooks, length, params)
    return length, codebooks


def codebooks_digest(codebooks: np.ndarray) -> str:
    """sha256 of all decimal components by part, entry and position."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def coded(table: DataFrame, params: CodeParameters = CodeParameters(), vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row per kept vector: id, code, error, label, error summed over equal labels, digest of the codebooks.

    A code has two hex digits a part, four with more than 256 entries.
    """
    vectors = table.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    length, codebooks = learned(vectors, params)
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    if not length:
        rows = vectors.limit(0).select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    else:
        rows = vectors.mapInArrow(_coding(codebooks, length, params), schema)
    codes, _ = stored(rows, "codes")
    # One row per label; broadcast only where that is small, and joined by a shuffle that splits hot labels otherwise.
    sums, _ = stored(codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "errors")
    joined = codes.join(broadcast_if_small(sums), F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label", "label_error", F.lit(codebooks_digest(codebooks)).alias("codebooks_sha256"))
