"""Fill-in-the-middle transformation on piece tables.

A document is an immutable buffer of UTF-8 bytes, the sentinels are another one, and a text is a list of descriptors
(buffer, start, size) over them. Cutting splits a descriptor, an arrangement permutes the descriptors, the inverse
permutation restores the document, and hashes are fed descriptor by descriptor, so no step copies a part of the text. An
output is put together once, where it is returned.

Defined cases: a NULL text is empty; an empty text and one that holds a sentinel stay plain; a NULL key is hashed as the
empty text. Rows with the same key get the same cuts in proportion to their own tokens. Nothing is shuffled, and memory
is bounded by one batch of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
TEXT_BUFFER, SENTINEL_BUFFER = 0, 1
#: Of the descriptors (prefix, middle, suffix, P, S, M), the order in which each form has them.
ARRANGEMENTS = {"psm": (3, 0, 4, 2, 5, 1), "spm": (4, 2, 3, 0, 5, 1)}
#: Most bytes of texts in one batch that a task hands back.
BATCH_BYTES = 16 << 20

PIECES = "array<struct<buffer: int, start: long, size: long>>"


@dataclass(frozen=True)
class MiddleParameters:
    """Shares in percent of the documents that are transformed and, of these, of those that start with the suffix."""

    transformed: int = 90
    suffix_first: int = 20
    seed: int = 1


@dataclass(frozen=True)
class Piece:
    buffer: int
    start: int
    size: int


class PieceTable:
    """A text as descriptors over immutable buffers."""

    def __init__(self, buffers: Sequence[bytes], pieces: Sequence[Piece]) -> None:
        self.buffers = buffers
        self.pieces = list(pieces)

    def cut(self, place: int, offset: int) -> PieceTable:
        """The descriptor at ``place`` split in two, the first of which has ``offset`` bytes."""
        piece = self.pieces[place]
        halves = [Piece(piece.buffer, piece.start, offset), Piece(piece.buffer, piece.start + offset, piece.size - offset)]
        return PieceTable(self.buffers, [*self.pieces[:place], *halves, *self.pieces[place + 1 :]])

    def arranged(self, order: Sequence[int]) -> PieceTable:
        return PieceTable(self.buffers, [self.pieces[i] for i in order])

    def views(self) -> Iterator[memoryview]:
        """The bytes of each descriptor, uncopied."""
        for piece in self.pieces:
            yield memoryview(self.buffers[piece.buffer])[piece.start : piece.start + piece.size]

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for view in self.views():
            digest.update(view)
        return digest.hexdigest()

    def content(self) -> bytes:
        return b"".join(self.views())


def inverse(order: Sequence[int]) -> list[int]:
    """The permutation that undoes ``order``."""
    back = [0] * len(order)
    for place, source in enumerate(order):
        back[source] = place
    return back


def token_starts(text: bytes) -> np.ndarray:
    """Byte offsets where the tokens ``[A-Za-z]+|[^A-Za-z]`` of UTF-8 bytes start."""
    data = np.frombuffer(text, np.uint8)
    letter = ((data | 32) - np.uint8(97)) < 26
    starts = (data & 0xC0) != 0x80
    starts[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(starts)


def code_points(text: memoryview) -> int:
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def draws(key: str, seed: int) -> list[int]:
    """Four numbers of 32 bits from the hash of seed and key."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def transformed(key: str, text: bytes, params: MiddleParameters = MiddleParameters()) -> tuple[int, str, PieceTable]:
    """Number of tokens, form, and piece table of the output."""
    whole = PieceTable((text, SENTINELS), [Piece(TEXT_BUFFER, 0, len(text))])
    starts = token_starts(text)
    n = len(starts)
    h1, h2, h3, h4 = draws(key, params.seed)
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= params.transformed:
        return n, "plain", whole
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    begin, end = (int(starts[unit]) if unit < n else len(text) for unit in (first, second))
    parts = whole.cut(0, begin).cut(1, end - begin)
    width = len(PREFIX)
    marks = [Piece(SENTINEL_BUFFER, i * width, width) for i in range(3)]
    form = "spm" if h4 % 100 < params.suffix_first else "psm"
    return n, form, PieceTable(parts.buffers, [*parts.pieces, *marks]).arranged(ARRANGEMENTS[form])


def restored_text(output: bytes, form: str) -> PieceTable:
    """The document of an output: its descriptors are found by the sentinels, permuted back, and rid of the sentinels.

    A part holds no sentinel, and no sentinel begins within another, so the first place of each is the one written.
    """
    whole = PieceTable((output,), [Piece(0, 0, len(output))])
    if form not in ARRANGEMENTS:
        return whole
    table, place = whole, 0
    for number in ARRANGEMENTS[form]:
        if number < 3:
            continue
        mark = SENTINELS[(number - 3) * 3 : (number - 2) * 3]
        rest = table.pieces[place]
        at = output.find(mark, rest.start)
        if at < 0:
            raise ValueError(f"An output of form {form} has no {mark.decode()}.")
        if place:  # what lies before the mark is a part of the document; nothing lies before the first
            table, place = table.cut(place, at - rest.start), place + 1
        table, place = table.cut(place, len(mark)), place + 1
    return PieceTable(table.buffers, table.arranged(inverse(ARRANGEMENTS[form])).pieces[:3])


def _slices(sizes: Sequence[int]) -> Iterator[range]:
    """Row numbers in runs of at most ``BATCH_BYTES``, one row at least."""
    begin = total = 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > BATCH_BYTES:
            yield range(begin, i)
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield range(begin, len(sizes))


def _text(value) -> memoryview | bytes:
    """The bytes of an Arrow string, uncopied."""
    return b"" if not value.is_valid else value.as_buffer().to_pybytes()


def _transforming(params: MiddleParameters, kept: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(kept), batch.column(kept + 1)
            for rows in _slices([v.as_buffer().size if v.is_valid else 0 for v in texts]):
                out: list[list] = [[] for _ in range(7)]
                for i in rows:
                    n, form, table = transformed(keys[i].as_py() or "", _text(texts[i]), params)
                    views = list(table.views())
                    places = [ARRANGEMENTS[form].index(part) for part in (0, 1)] if form != "plain" else []
                    sizes = [code_points(views[place]) for place in places] or [None, None]
                    pieces = [{"buffer": p.buffer, "start": p.start, "size": p.size} for p in table.pieces]
                    for column, value in zip(out, (n, form, *sizes, table.content(), table.sha256(), pieces), strict=True):
                        column.append(value)
                same = [batch.column(c).slice(rows.start, len(rows)) for c in range(kept)]
                added = [pa.array(v, schema.field(kept + c).type) for c, v in enumerate(out)]
                yield pa.RecordBatch.from_arrays([*same, *added], names=schema.names)

    return run


def _restoring(kept: int, schema: pa.Schema, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms, outputs = batch.column(kept), batch.column(kept + 1)
            for rows in _slices([v.as_buffer().size if v.is_valid else 0 for v in outputs]):
                tables = [restored_text(_text(outputs[i]), forms[i].as_py()) for i in rows]
                added = [pa.array([t.sha256() for t in tables], pa.string())]
                if with_text:
                    added.insert(0, pa.array([t.content() for t in tables], pa.string()))
                same = [batch.column(c).slice(rows.start, len(rows)) for c in range(kept)]
                yield pa.RecordBatch.from_arrays([*same, *added], names=schema.names)

    return run


def _extended(rows: DataFrame, kept: int, added: str) -> tuple[StructType, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType(rows.schema.fields[:kept] + StructType.fromDDL(added).fields)
    return schema, to_arrow_schema(schema)


def fill_in_middle(docs: DataFrame, keep: Sequence[Column], params: MiddleParameters = MiddleParameters(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns ``keep`` of every row with its transformed text.

    ``n`` counts tokens, ``form`` is plain, psm or spm, ``prefix_chars`` and ``middle_chars`` are code points, ``output``
    is the text to train on, ``output_sha256`` its hash, and ``pieces`` its descriptors over the text (0) and the
    sentinels (1).
    """
    rows = docs.select(*keep, F.col(key).cast("string").alias("_key"), F.col(text).alias("_text"))
    added = f"n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string, pieces {PIECES}"
    schema, arrow = _extended(rows, len(keep), added)
    return rows.mapInArrow(_transforming(params, len(keep), arrow), schema)


def restored(rows: DataFrame, keep: Sequence[Column], output: str = "output", form: str = "form", with_text: bool = True) -> DataFrame:
    """The columns ``keep`` of every row with the document (``text``) behind an output, and its ``restored_sha256``."""
    picked = rows.select(*keep, F.col(form).alias("_form"), F.col(output).alias("_output"))
    schema, arrow = _extended(picked, len(keep), ("text string, " if with_text else "") + "restored_sha256 string")
    return picked.mapInArrow(_restoring(len(keep), arrow, with_text), schema)
