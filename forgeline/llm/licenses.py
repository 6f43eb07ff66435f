"""License notices in texts: winnowed fingerprints pick candidates, banded alignment confirms them.

Templates are cut into k-word grams; of every window of w neighbouring grams the one with the smallest hash
is kept, at its place (winnowing, Schleimer et al., 2003), which makes an inverted index. A text's grams are
looked up in it; hits of a template on about the same diagonal are one candidate. Local alignment of
the words, within a band around the diagonal, gives the share of the template that
matches and where. Any stretch of w + k - 1 unchanged words of a template is sure to be found.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_slices, packed

WORD = re.compile(r"[^\W_]+")

#: Notices as the licenses give them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."
    ),
    "MIT": "Released under the MIT License.",
    "MIT grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
    ),
}


@dataclass(frozen=True)
class Scan:
    """Parameters of the scan."""

    gram: int = 3
    window: int = 2
    band: int = 8  #: words that may be added or lost along a match
    coverage: float = 0.75  #: share of a template's words from which a match is reported


@dataclass(frozen=True)
class Index:
    words: dict[str, list[str]]
    grams: dict[tuple[str, ...], list[tuple[str, int]]] = field(default_factory=dict)


def index(templates: dict[str, str], how: Scan = Scan()) -> Index:
    """The inverted index of the templates; one shorter than a gram is a gram of its own length."""
    out = Index({name: WORD.findall(text.lower()) for name, text in templates.items()})
    for name, body in out.words.items():
        k = min(how.gram, len(body))
        grams = [tuple(body[i : i + k]) for i in range(len(body) - k + 1)] if body else []
        hashes = [xxhash.xxh64_intdigest(" ".join(g)) for g in grams]
        kept = set()
        for first in range(max(1, len(grams) - how.window + 1) if grams else 0):
            kept.add(min(range(first, min(first + how.window, len(grams))), key=lambda i: (hashes[i], -i)))
        for i in sorted(kept):
            out.grams.setdefault(grams[i], []).append((name, i))
    return out


def align(template: list[str], text: list[str], diagonal: int, band: int, low: int, high: int) -> tuple[int, int, int]:
    """Best local alignment near the diagonal with words ``low`` to ``high`` of ``text``: (matched
    words, first, end).

    A match scores 2, a difference, an added or a lost word -1. The table has 2 band + 1 cells per
    word of the template.
    """
    width = 2 * band + 1
    empty = (0, 0, -1, -1)  # score, matched, first, end
    row, best = [empty] * (width + 1), empty
    for i, word in enumerate(template):
        now = [empty] * (width + 1)
        for c in range(width):
            j = i + diagonal + c - band
            if not low <= j < high:
                continue
            score, matched, first, end = row[c]  # the cell of the words before both
            if text[j] == word:
                cell = (score + 2, matched + 1, j if score == 0 else first, j + 1)
            else:
                cell = max((score - 1, matched, first, end), empty, key=lambda x: x[0])
            for other in (row[c + 1], now[c - 1] if c else empty):
                if other[0] - 1 > cell[0]:
                    cell = (other[0] - 1, *other[1:])
            now[c] = cell
            if (cell[0], cell[1]) > (best[0], best[1]):
                best = cell
        row = now
    return best[1], best[2], best[3]


MATCHES = pa.list_(
    pa.struct(
        [("license", pa.string()), ("coverage", pa.float64()), ("matched_words", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]
    )
)


def _spans(template: list[str], body: list[str], hits: list[tuple[int, int]], how: Scan) -> list[tuple[int, int, int]]:
    """All matches (matched words, first, end) of one template that do not overlap.

    Every diagonal of a hit (place in the text, diagonal) is aligned. Of matches that overlap, the one with
    more matched words stays, then the earlier one; the hits outside of all that stay are aligned
    again with the words left between them, until nothing is found.
    """
    out: list[tuple[int, int, int]] = []
    tried = set()
    while True:
        edges = [0, *(edge for _, first, end in sorted(out, key=lambda m: m[1]) for edge in (first, end)), len(body)]
        found = set()
        for at, diagonal in hits:
            k = bisect_right(edges, at) - 1
            if k % 2:
                continue  # lies inside a match
            low = max(edges[k], diagonal - how.band)
            high = min(edges[k + 1], diagonal + len(template) + how.band)
            if (diagonal, low, high) in tried:
                continue
            tried.add((diagonal, low, high))
            match = align(template, body, diagonal, how.band, low, high)
            if match[0] >= how.coverage * len(template):
                found.add(match)
        if not found:
            return out
        taken: list[tuple[int, int]] = []
        for matched, first, end in sorted(found, key=lambda m: (-m[0], m[1], m[2])):
            k = bisect_right(taken, (first, end))
            if (k == 0 or taken[k - 1][1] <= first) and (k == len(taken) or end <= taken[k][0]):
                taken.insert(k, (first, end))
                out.append((matched, first, end))


def find(text: str, known: Index, how: Scan) -> list[dict]:
    """The matches of one text: license, coverage, matched words, and the span in characters.

    Of matches that overlap, the one with more matched words stays; among equals that of the name first in
    order, then the earlier one.
    """
    spans = [m.span() for m in WORD.finditer(text)]
    body = [text[a:b].lower() for a, b in spans]
    hits: dict[str, list[tuple[int, int]]] = defaultdict(list)
    for k in {len(g) for g in known.grams}:
        for at, gram in enumerate(zip(*(body[i:] for i in range(k)))):
            for name, i in known.grams.get(gram, ()):
                hits[name].append((at, at - i))
    found = []
    for name, places in hits.items():
        template = known.words[name]
        for matched, first, end in _spans(template, body, places, how):
            found.append((-matched, name, first, end, matched / len(template)))
    kept: list[tuple] = []
    for match in sorted(set(found)):
        if all(match[3] <= other[2] or match[2] >= other[3] for other in kept):
            kept.append(match)
    return [
        {"license": n, "coverage": c, "matched_words": -m, "start": spans[a][0], "end": spans[b - 1][1]}
        for m, n, a, b, c in sorted(kept, key=lambda x: x[2])
    ]


def scanned(docs: DataFrame, templates: dict[str, str] = TEMPLATES, how: Scan = Scan(), text: str = "text", doc_id: str = "doc_id", keep_rows: bool = True) -> DataFrame:
    """Every document (``row``, or only ``id``) with the array ``matches``.

    Null and empty texts have none, and nothing has any without templates. Repeated rows match
    alike; rows without an id are scanned like others. An empty table gives no rows. The templates are
    the scan's configuration and travel with the task.
    """
    known = index(templates, how)

    def scan(texts: list[str]) -> pa.Array:
        return pa.array([find(t, known, how) for t in texts], MATCHES)

    base = packed(docs, id=f"{doc_id}:bigint", text=text)
    base = base if keep_rows else base.drop("row")
    kinds = "array<struct<license string, coverage double, matched_words bigint, start bigint, end bigint>>"
    return base.withColumn("matches", F.arrow_udf(by_slices(scan, MATCHES), kinds)("text")).drop("text")


def op10(docs: DataFrame) -> DataFrame:
    """One row per match."""
    rows = scanned(docs, keep_rows=False)
    return rows.select(F.col("id").alias("doc_id"), F.explode("matches").alias("m")).select("doc_id", "m.*")
