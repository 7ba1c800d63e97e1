"""Word features in numpy inside tasks: texts to word numbers, and hashed n-gram features of distinct words."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np

LETTERS = re.compile(r"[^\W\d_]+")


def chunked(texts: Iterable[str | None], characters: int = 4_000_000) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about so many characters with the index of their first; NULL becomes the empty text."""
    first, run, size = 0, [], 0
    for i, text in enumerate(texts):
        run.append(text or "")
        size += len(run[-1])
        if size >= characters:
            yield first, run
            first, run, size = i + 1, [], 0
    if run:
        yield first, run


def padded(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words with a blank around each, and the offset of the blank before each word."""
    codes = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    return codes, np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))


def trigram_cells(codes: np.ndarray, bits: int) -> np.ndarray:
    """Hash cell of the three code points from each place on; the last two places have none."""
    a = codes.astype(np.uint64)
    mixed = a[:-2] * np.uint64(0x9E3779B97F4A7C15) + a[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + a[2:] * np.uint64(0x165667B19E3779F9)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


class WordScores:
    """Rows of scores for words, computed once for each distinct word while they fit in a bounded cache."""

    def __init__(self, score: Callable[[list[str]], np.ndarray], width: int, most: int = 400_000):
        self.score, self.width, self.most = score, width, most
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.rows = np.zeros((1024, self.width), dtype=np.float32)

    def of(self, words: list[str]) -> np.ndarray:
        """A row for each word; the cache starts anew when it is full."""
        if not words:
            return np.zeros((0, self.width), dtype=np.float32)
        if len(self.numbers) > self.most:
            self.forget()
        new = list(set(words) - self.numbers.keys())
        if new:
            new.sort()
            first = len(self.numbers)
            while first + len(new) > len(self.rows):
                self.rows = np.concatenate((self.rows, np.zeros_like(self.rows)))
            self.rows[first : first + len(new)] = self.score(new)
            self.numbers.update(zip(new, range(first, first + len(new)), strict=True))
        return self.rows[np.fromiter(map(self.numbers.__getitem__, words), dtype=np.int64, count=len(words))]
