"""License scans: winnowed fingerprints pick candidates, banded alignment measures them.

The templates are few and their index is sent to the tasks; the documents are
read once and nothing is shuffled. A template is looked for only where a
document shares winnowed fingerprints with it, near the diagonal they lie on.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.text import as_bytes, hashed_words, map_batches, mixed, quoted_col

# Words of a fingerprint, and how many neighbours each winnowing window holds.
# Any run of GRAM + WINDOW - 1 = 4 words that both texts share has a common one.
GRAM = 3
WINDOW = 2
# Words that a match may shift against its diagonal.
BAND = 8
# Least share of a template's words that a match covers, in percent.
COVERAGE_PERCENT = 75

# Notices and opening paragraphs of public licenses.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "mit-line": "Released under the MIT License.",
    "apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        "in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License."
    ),
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software."
    ),
    "bsd-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:"
    ),
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version."
    ),
}

_EDGES = b".,;:!?\"'()[]{}<>*#"
_PLAIN = re.compile(rb"[^\x20\x09-\x0D]+")


def plain(words: list[bytes]) -> list[bytes]:
    """Words in lower case, without punctuation at their ends."""
    return [w.strip(_EDGES) for w in words]


def grams(words: list[bytes]) -> np.ndarray:
    hashes = hashed_words(words)
    n = len(hashes) - GRAM + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:n].copy()
    for place in range(1, GRAM):
        out = mixed(out) + hashes[place : n + place]
    return mixed(out)


def winnowed(hashes: np.ndarray) -> np.ndarray:
    """Places of the smallest hash, the rightmost of equals, of every window."""
    n = len(hashes) - WINDOW + 1
    if n <= 0:
        return np.arange(len(hashes))
    least, place = hashes[:n].copy(), np.arange(n)
    for step in range(1, WINDOW):
        lower = hashes[step : n + step] <= least
        least = np.where(lower, hashes[step : n + step], least)
        place = np.where(lower, np.arange(n) + step, place)
    return np.unique(place)


@dataclass(frozen=True)
class Index:
    """Fingerprints of all templates in order, and where each comes from."""

    names: list[str]
    words: list[list[bytes]]
    prints: np.ndarray
    owner: np.ndarray
    place: np.ndarray

    @staticmethod
    def of(templates: dict[str, str]) -> Index:
        words = [plain(text.lower().encode().split()) for text in templates.values()]
        found = []
        for number, template in enumerate(words):
            hashes = grams(template)
            found += [(int(hashes[p]), number, int(p)) for p in winnowed(hashes)]
        found.sort()
        columns = list(zip(*found, strict=True)) if found else [[], [], []]
        return Index(
            list(templates),
            words,
            np.array(columns[0], np.uint64),
            np.array(columns[1], np.int64),
            np.array(columns[2], np.int64),
        )

    def candidates(self, words: list[bytes]) -> dict[int, list[int]]:
        """By template: the diagonals, text place less template place, of shared fingerprints."""
        hashes = grams(words)
        places = winnowed(hashes)
        chosen = hashes[places]
        low = np.searchsorted(self.prints, chosen, "left")
        high = np.searchsorted(self.prints, chosen, "right")
        found = defaultdict(list)
        for hit in np.flatnonzero(high > low):
            for entry in range(low[hit], high[hit]):
                found[int(self.owner[entry])].append(int(places[hit] - self.place[entry]))
        return found


def aligned(template: list[bytes], text: list[bytes], band: int = BAND) -> tuple[int, int, int]:
    """Best alignment of a template with a stretch of text: matched words, start, end.

    ``text`` begins ``band`` words before the diagonal, and only cells within
    ``band`` of it are filled. Words match or are passed over; the template may
    start and end anywhere. The most matched words win, then the shortest
    stretch, then the one that starts nearest to the diagonal, so that notices
    one behind another are found from their own. Start and end are places in ``text``, end past the last match.
    """
    width = 2 * band + 1
    # Of each cell: matched words, minus the length of the stretch, its start and end.
    empty = (0, 0, -1, -1)
    above = [empty] * (width + 1)
    for row, word in enumerate(template):
        here = [empty] * (width + 1)
        for offset in range(width):
            at = row + offset
            best = above[offset + 1]  # the template's word is passed over
            if offset and here[offset - 1] > best:  # the text's word is
                best = here[offset - 1]
            if at < len(text) and text[at] == word:
                matched, _, start, _ = above[offset]
                start = at if start < 0 else start
                best = max(best, (matched + 1, start - at - 1, start, at + 1))
            here[offset] = best
        above = here
    matched, _, start, end = max(above, key=lambda c: (c[0], c[1], -abs(c[2] - band), c))
    return matched, start, end


def matches(index: Index, text: bytes | None, percent: int = COVERAGE_PERCENT):
    """(template, matched words, first word, end word, first byte, end byte) of each match."""
    raw = (text or b"").split()
    words = plain([w.lower() for w in raw])
    found = []
    for number, diagonals in index.candidates(words).items():
        template = index.words[number]
        spans = []
        # Neighbouring diagonals share a band; one stands for those it reaches.
        last = None
        for diagonal in sorted(set(diagonals)):
            if last is not None and diagonal - last <= min(BAND // 2, len(template) - 1):
                continue
            last = diagonal
            first = max(diagonal - BAND, 0)
            # Before the text's first word there is nothing to align with.
            lead = [b""] * (first - (diagonal - BAND))
            stretch = lead + words[first : diagonal + len(template) + BAND]
            matched, start, end = aligned(template, stretch)
            if 100 * matched >= percent * len(template):
                shift = first - len(lead)
                spans.append((-matched, end - start, start + shift, end + shift))
        taken: list[tuple[int, int]] = []
        for lacking, _, start, end in sorted(spans):
            if all(end <= a or start >= b for a, b in taken):
                taken.append((start, end))
                found.append((number, -lacking, start, end))
    if not found:
        return []
    places = [m.span() for m in _PLAIN.finditer(text)]
    return [
        (index.names[n], matched, start, end, places[start][0], places[end - 1][1])
        for n, matched, start, end in sorted(found, key=lambda m: (m[2], m[3], m[0]))
    ]


def scan(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    text: str = "text",
    doc_id: str = "doc_id",
    percent: int = COVERAGE_PERCENT,
) -> DataFrame:
    """One row per match: id, license, coverage, matched_words, and its span.

    ``coverage`` is the share of the template's words that match, from 0 to 1.
    The span is given in words and in bytes of the text's UTF-8, ends
    excluded. A text may match several templates, and one template at several
    places that do not overlap. NULL and empty texts match nothing, and so do
    templates of fewer than ``GRAM`` words. Ids may be NULL and repeat: every
    row is scanned, the whole text of it.
    """
    index = Index.of(TEMPLATES if templates is None else templates)
    sizes = dict(zip(index.names, map(len, index.words), strict=True))
    rows = docs.select(quoted_col(doc_id).alias("id"), quoted_col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def scanned(batch):
        owner, found = [], []
        for row, body in enumerate(as_bytes(batch.column(1))):
            for match in matches(index, body, percent):
                owner.append(row)
                found.append(match)
        if not found:
            return
        names, matched, start, end, first, past = zip(*found, strict=True)
        coverage = [m / sizes[n] for n, m in zip(names, matched, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(owner)),
                pa.array(names),
                pa.array(coverage),
                *[pa.array(c, pa.int64()) for c in (matched, start, end, first, past)],
            ],
            ["id", "license", "coverage", "matched_words", "start_word", "end_word", "start_byte", "end_byte"],
        )

    return map_batches(
        rows,
        scanned,
        f"id {kind}, license string, coverage double, matched_words bigint, "
        "start_word bigint, end_word bigint, start_byte bigint, end_byte bigint",
    )
