"""License scans by conditional compression.

Texts are searched by paragraphs (runs of lines with words), long ones in overlapping runs that hold any notice whole,
so a notice may be wrapped over lines and have comment marks. A candidate block, one with a word that a template cannot do
without, is compressed alone and with every template as a raw zstandard dictionary, in lower case, and the templates are
ranked by the bytes that they save. Each of those that save a share of the notice's bytes is confirmed by exact
differences in wording: at every place that no permitted difference could break, the template's words must be found in
order, up to a few missing or put in, and words that tell licenses apart (names, numbers) must all be there. Where confirmed
places overlap, the template that saves most is reported.

Texts without a word that any template needs never reach Python.

Defined cases: a NULL or empty text has no block; a block may hold several notices, each reported once with its best
template, and once if it repeats on the line where it begins; repeated rows get equal results; a NULL id is kept; other
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Notices as their licenses word them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights. CC0 1.0 Universal.",
}
#: The last bytes of a raw dictionary are not searched for matches, so a template has blanks around it.
EDGE = " " * 16
MARGIN = re.compile(r"\s*\n[^\w\n]*")  # line ends with the indents and comment marks after them
TOKEN = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
#: Words that carry no license's name; all others of a template must be in the block.
COMMON = frozenset(
    "a all and any are as at be by for from free in is it may no not obtain of on or that the this to under with you work released licensed license licence "
    "copy use file compliance except terms public general version v".split()
)


@dataclass(frozen=True)
class ScanParameters:
    least_gain: float = 0.15  # share of a notice's bytes that its template must save
    missing: float = 0.15  # share of a template's words that may be missing, and be put in
    short_missing: int = 1  # so many common words may be missing and
    short_extra: int = 3  # so many common words be put in, however short the template is
    level: int = 6
    window: int = 2000  # a longer paragraph is scanned in overlapping runs of so many characters, or four times the longest template


def tokens(text: str) -> list[str]:
    return [t.lower() for t in TOKEN.findall(text)]


def needed_words(template: str, params: ScanParameters) -> list[str]:
    """Words of which every place of a template has one: a word that may not be missing, or one more than may be."""
    words = list(dict.fromkeys(tokens(template)))
    own = sorted((w for w in words if w not in COMMON), key=lambda w: (-len(w), w))
    slack = max(params.short_missing, int(params.missing * len(tokens(template))))
    return own[:1] or sorted(words, key=lambda w: (-len(w), w))[: slack + 1]


def trigger(templates: dict[str, str], params: ScanParameters) -> str:
    """Pattern of a text that may hold a notice, for Spark and Python alike."""
    words = sorted({w for text in templates.values() for w in needed_words(text, params)})
    quoted = "|".join(re.sub(r"([.-])", r"\\\1", w) for w in words)
    return f"(?i)(?<![A-Za-z0-9])(?:{quoted})(?![A-Za-z0-9])"


class Ranking:
    """Templates as dictionaries, which tell how many bytes of a block each one saves."""

    def __init__(self, templates: dict[str, str], params: ScanParameters) -> None:
        self.templates, self.params = templates, params
        self.words = {name: tokens(text) for name, text in templates.items()}
        self.sizes = {name: len(text.encode()) for name, text in templates.items()}
        self.alone = zstandard.ZstdCompressor(level=params.level, write_content_size=False)
        self.given = {}
        for name, text in templates.items():
            dictionary = zstandard.ZstdCompressionDict((EDGE + text.lower() + EDGE).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.given[name] = zstandard.ZstdCompressor(level=params.level, dict_data=dictionary, write_content_size=False)

    def __call__(self, block: str) -> list[tuple[int, float, str]]:
        """Saved bytes, their share of the shorter of block and template, and name, most bytes first."""
        raw = MARGIN.sub(" ", block).lower().encode()
        alone = len(self.alone.compress(raw))
        saved = [(alone - len(c.compress(raw)), name) for name, c in self.given.items()]
        return sorted(((n, n / max(1, min(len(raw), self.sizes[name])), name) for n, name in saved), key=lambda x: (-x[0], x[2]))


def places(template: list[str], block: list[str], missing: int, extra: int) -> list[tuple[int, int]]:
    """Ranges of block words that hold every place with at most so many template words missing and block words put in.

    So few differences leave a run of at least ``q`` template words whole, which fixes the place up to the slack.
    """
    slack = max(missing, extra)
    q = max(1, -(-(len(template) - missing) // (missing + extra + 1)))
    at: dict[tuple[str, ...], list[int]] = {}
    for i in range(len(template) - q + 1):
        at.setdefault(tuple(template[i : i + q]), []).append(i)
    starts = sorted({j - i for j in range(len(block) - q + 1) for i in at.get(tuple(block[j : j + q]), ())})
    ranges, k = [], 0
    while k < len(starts):
        first = last = starts[k]
        while k < len(starts) and starts[k] <= first + slack:
            last = starts[k]
            k += 1
        ranges.append((max(0, first - slack), min(len(block), last + len(template) + slack)))
    return ranges


def wording(template: list[str], block: list[str], free: int = 0) -> tuple[list[str], list[str], int, int]:
    """Template words missing, block words put in between, and the range of block words from first to last match.

    A run at either end that costs more words in between than it has is left out; ``free`` common words cost nothing.
    """
    runs = [m for m in SequenceMatcher(None, template, block, autojunk=False).get_matching_blocks() if m.size]

    def cost(before, after) -> int:
        gap = block[before.b + before.size : after.b]
        return len(gap) - min(free, sum(w in COMMON for w in gap))

    while len(runs) > 1 and runs[0].size < cost(runs[0], runs[1]):
        runs = runs[1:]
    while len(runs) > 1 and runs[-1].size < cost(runs[-2], runs[-1]):
        runs = runs[:-1]
    if not runs:
        return list(template), [], 0, 0
    begin, end = runs[0].b, runs[-1].b + runs[-1].size
    matched_a = {i for m in runs for i in range(m.a, m.a + m.size)}
    matched_b = {i for m in runs for i in range(m.b, m.b + m.size)}
    return [w for i, w in enumerate(template) if i not in matched_a], [block[i] for i in range(begin, end) if i not in matched_b], begin, end


def scan_block(block: str, ranking: Ranking) -> list[dict]:
    """Confirmed notices of one paragraph, those whose templates save most first, with the characters of their lines."""
    params = ranking.params
    spans = [m.span() for m in TOKEN.finditer(block)]
    own = [block[a:b].lower() for a, b in spans]
    found: list[dict] = []
    taken: list[tuple[int, int]] = []
    for _, share, name in ranking(block):
        if share < params.least_gain:
            continue
        words = ranking.words[name]
        slack = int(params.missing * len(words))
        sites = []
        for lo, hi in places(words, own, max(slack, params.short_missing), max(slack, params.short_extra)):
            missing, extra, begin, end = wording(words, own[lo:hi], params.short_extra)
            few = len(missing) <= slack and len(extra) <= slack
            small = len(missing) <= params.short_missing and len(extra) <= params.short_extra and all(w in COMMON for w in extra)
            if begin < end and all(w in COMMON for w in missing) and (few or small):
                sites.append((len(missing) + len(extra), begin + lo, end + lo, missing, extra))
        for _, begin, end, missing, extra in sorted(sites):
            if any(begin < e and b < end for b, e in taken):
                continue
            taken.append((begin, end))
            first = block.rfind("\n", 0, spans[begin][0]) + 1
            last = block.find("\n", spans[end - 1][1])
            facts = {"license": name, "gain": round(share, 6), "missing": missing, "extra": extra, "exact": not missing and not extra}
            found.append(facts | {"begin": first, "end": len(block) if last < 0 else last, "at": spans[begin][0]})
    return found


def pieces(text: str, window: int, needed: re.Pattern) -> Iterator[tuple[int, str]]:
    """Paragraphs with a word that a template needs, offset first; a long one in overlapping runs."""
    at = begin = 0
    for line in [*text.split("\n"), ""]:
        if not re.search(r"\w", line):
            paragraph = text[begin : max(begin, at - 1)]
            if needed.search(paragraph):
                for k in range(0, max(1, len(paragraph) - window // 2), window // 2):
                    if needed.search(paragraph[k : k + window]):
                        yield begin + k, paragraph[k : k + window]
            begin = at + len(line) + 1
        at += len(line) + 1


FOUND = pa.struct(
    [("offset", pa.int32()), ("block", pa.string()), ("license", pa.string()), ("gain", pa.float64()), ("exact", pa.bool_()), ("missing", pa.list_(pa.string())), ("extra", pa.list_(pa.string()))]
)
RESULT = "offset int, block string, license string, gain double, exact boolean, missing array<string>, extra array<string>"


def _scanning(templates: dict[str, str], params: ScanParameters, pattern: str):
    """Task function: ids and texts to one row per confirmed notice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranking, needed = Ranking(templates, params), re.compile(pattern)
        known: dict[str, list[dict]] = {}
        window = max(params.window, 4 * max(map(len, templates.values())))
        for batch in batches:
            rows, out = [], []
            for number, text in enumerate(batch.column(1).to_pylist()):
                seen = set()
                for offset, block in pieces(text, window, needed):
                    if block not in known:
                        if len(known) > 10_000:
                            known.clear()
                        known[block] = scan_block(block, ranking)
                    for notice in known[block]:
                        mark = (text.count("\n", 0, offset + notice["at"]), notice["license"])
                        if mark not in seen:
                            seen.add(mark)
                            rows.append(number)
                            out.append({"offset": offset + notice["begin"], "block": block[notice["begin"] : notice["end"]]} | notice)
            found = pa.array([{f.name: notice[f.name] for f in FOUND} for notice in out], FOUND)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int32())), *found.flatten()], names=["doc_id", *[f.name for f in FOUND]])

    return run


def scanned(docs: DataFrame, templates: dict[str, str] | None = None, params: ScanParameters = ScanParameters(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per confirmed notice: document, offset and text of its block, license, gain, and differences in wording."""
    templates = templates or TEMPLATES
    pattern = trigger(templates, params)
    rows = docs.where(F.col(text).rlike(pattern)).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_scanning(templates, params, pattern), f"doc_id {rows.schema[0].dataType.simpleString()}, {RESULT}")
