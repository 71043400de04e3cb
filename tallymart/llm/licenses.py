"""License scans: winnowed fingerprints pick candidates, banded alignment reports coverage and spans.

Texts and templates are sequences of lower-case words of letters and digits. Hashed runs of ``gram`` words are
winnowed: of every ``window`` neighbouring runs the least is kept, so a stretch of gram + window - 1 words that a
template and a document share has a fingerprint in common. The window is as wide as it may be without losing a match:
where a fifth of the words is changed, four in a row may be all that is left, so at a coverage of 0.8 runs of three
have a window of two; at 0.9 it is seven. The inverted index maps a fingerprint to its templates
and positions. Hits of a template that lie near one diagonal are a candidate stretch; local alignment within a band
around the diagonal gives the matched words of the template, its coverage, and the span in the source text. A match
is masked and the rest of the stretch aligned again until no hit is left.

A template's runs are as short as it takes that one survives wherever words are changed or left out and the coverage
is still reached; short templates keep every run. A match inside the span of a longer one is not reported. Words put in between cost no coverage; such a match is met if enough runs survive them.

Scale: a map over the scan; the index grows with the templates only and its size is checked before it is sent out.
Words that no template has share one number, which changes no fingerprint inside a shared stretch.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, replace
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = re.compile(r"[^\W_]+")
SLICE = 128

#: Notices and first sentences of public licenses.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable "
        "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES "
        "OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "MIT notice": "Released under the MIT License.",
    "MIT permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
    ),
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD-3-Clause conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer."
    ),
    "MPL-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}


@dataclass(frozen=True)
class Scan:
    """Runs have ``gram`` words and windows ``window`` runs, fewer where a match could be lost. ``most_words`` bounds all
    templates together, since their index is sent to every worker."""

    gram: int = 3
    window: int = 8
    coverage: float = 0.8
    hits: float = 0.2
    band: int = 8
    most_words: int = 2_000_000


def fingerprints(numbers: np.ndarray, scan: Scan) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed hashes of a sequence of word numbers and where their runs begin."""
    n = len(numbers) - scan.gram + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for k in range(scan.gram):
        h = (h ^ numbers[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    if n <= scan.window:
        place = np.array([int(np.argmin(h))])
        return h[place], place
    views = np.lib.stride_tricks.sliding_window_view(h, scan.window)
    place = np.unique(np.argmin(views, axis=1) + np.arange(len(views)))
    return h[place], place


def number(word: str) -> int:
    return int.from_bytes(blake2b(word.encode(), digest_size=8).digest(), "little") | 1


def winnowing(words: int, scan: Scan) -> tuple[int, int, int]:
    """(words of a run, runs of a window, fingerprints that any match has in common) for a template of ``words``.

    Of the stretches between ``lost`` changed words some are left whole; one of n words has at least
    (n - gram + 1) // window fingerprints.
    """
    lost = words - int(np.ceil(scan.coverage * words - 1e-9))
    longest = -(-(words - lost) // (lost + 1))  # of the stretches left, one is as long as this
    gram = min(scan.gram, longest) or 1
    for window in range(min(scan.window, longest - gram + 1), 1, -1):
        sure = -(-(words - lost - (gram + window - 2) * (lost + 1)) // window)
        if sure >= 1:
            return gram, window, sure
    return gram, 1, max(1, words - gram + 1 - gram * lost)


class Index:
    """The inverted index over the templates; a template shorter than a run is found by its whole sequence only."""

    def __init__(self, templates: dict[str, str], scan: Scan) -> None:
        self.scan, self.names = scan, list(templates)
        found = [[w.lower() for w in WORD.findall(t)] for t in templates.values()]
        if sum(map(len, found)) > scan.most_words:
            raise ValueError(f"templates have over {scan.most_words} words; split them into several scans")
        self.vocabulary = {w: number(w) for words in found for w in words}
        self.templates = [[self.vocabulary[w] for w in words] for words in found]
        self.parts: dict[tuple[int, int], dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        self.need = [0] * len(found)
        for t, numbers in enumerate(self.templates):
            if not numbers:
                continue
            gram, window, sure = winnowing(len(numbers), scan)
            h, place = fingerprints(np.array(numbers, np.uint64), replace(scan, gram=gram, window=window))
            self.need[t] = max(1, min(sure, int(np.ceil(scan.hits * len(h)))))
            for x, p in zip(h.tolist(), place.tolist(), strict=True):
                self.parts[gram, window][x].append((t, p))
        self.hashes = {kind: np.array(sorted(places), np.uint64) for kind, places in self.parts.items()}

    def candidates(self, numbers: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """(template, hits) of stretches with enough hits, each the diagonal and the place in the text."""
        by: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for (gram, window), hashes in self.hashes.items():
            h, place = fingerprints(numbers, replace(self.scan, gram=gram, window=window))
            if not len(h):
                continue
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            hit = hashes[at] == h
            for x, p in zip(h[hit].tolist(), place[hit].tolist(), strict=True):
                for t, q in self.parts[gram, window][x]:
                    by[t].append((p - q, p))
        for t, hits in by.items():
            hits.sort()
            low = 0
            for k in range(1, len(hits) + 1):
                if k == len(hits) or hits[k][0] - hits[k - 1][0] > self.scan.band:
                    if k - low >= self.need[t]:
                        yield t, hits[low:k]
                    low = k


def align(template: list[int], text: list[int], shift: int, band: int) -> tuple[int, int, int]:
    """Best local alignment with the text position within ``band`` of template position plus ``shift``.

    Match 2, mismatch and gap -1. Returns matched words and the first and last text position matched.
    """
    width = 2 * band + 1
    best, where = 0, (0, 0, 0)
    # Each cell: score, matches, first matched position, last matched position.
    none = (0, 0, -1, -1)
    above = [none] * (width + 1)
    for i, word in enumerate(template):
        row = [none] * (width + 1)
        for c in range(width):
            j = i + shift - band + c
            if not 0 <= j < len(text):
                continue
            s, m, a, z = above[c]
            if text[j] == word:
                cell = (s + 2, m + 1, a if m else j, j)
            else:
                cell = (s - 1, m, a, z)
            up, left = above[c + 1], row[c - 1] if c else none
            if up[0] - 1 > cell[0]:
                cell = (up[0] - 1, *up[1:])
            if left[0] - 1 > cell[0]:
                cell = (left[0] - 1, *left[1:])
            if cell[0] <= 0:
                cell = none
            row[c] = cell
            if cell[0] > best:
                best, where = cell[0], cell[1:]
        above = row
    return where


def scan_text(text: str, index: Index) -> list[tuple[str, int, int, int, float]]:
    """(template, start, end, matched words, coverage) of every match; positions are code points."""
    scan = index.scan
    known = index.vocabulary.get
    words = [w.lower() for w in WORD.findall(text)]
    numbers = np.array([known(w, 0) for w in words], np.uint64)
    if not np.count_nonzero(numbers):
        return []
    found, spans = set(), None
    open_words: dict[int, np.ndarray] = {}
    for t, hits in index.candidates(numbers):
        size = len(index.templates[t])
        text_now = open_words.setdefault(t, numbers.copy())
        for a, z, matched in matches(index.templates[t], text_now, hits, index.need[t], scan):
            if spans is None:
                spans = [m.span() for m in WORD.finditer(text)]
            found.add((index.names[t], spans[a][0], spans[z][1], matched, matched / size))
    return outermost(found)


def outermost(found: set[tuple[str, int, int, int, float]]) -> list[tuple[str, int, int, int, float]]:
    """The matches that lie in no longer one; of several with one span those that cover most of their template."""
    kept, reached, last = [], -1, None
    for match in sorted(found, key=lambda m: (m[1], -m[2], -m[4], m[0])):
        span = match[1:3]
        if span == last and match[4] == kept[-1][4] or match[2] > reached:
            kept.append(match)
            reached, last = max(reached, match[2]), span
    return sorted(kept)


def matches(template: list[int], numbers: np.ndarray, hits: list[tuple[int, int]], need: int, scan: Scan) -> Iterator[tuple[int, int, int]]:
    """(first word, last word, matched words) of the matches of a stretch; their words are set to 0 in ``numbers``.

    The whole stretch is aligned first, then what is left of it in pieces of 2 * band diagonals.
    """
    band = max(scan.band, len(template) // 8)
    whole = True
    while len(hits) >= need:
        low = hits[0][0]
        last = len(hits) if whole else bisect_right(hits, (low + 2 * band, len(numbers)))
        high = hits[last - 1][0]
        wide, middle = band + (high - low + 1) // 2, (low + high) // 2
        start = max(0, middle - wide)
        stop = min(len(numbers), middle + len(template) + wide + 1)
        matched, a, z = align(template, numbers[start:stop].tolist(), middle - start, wide)
        full = matched >= scan.coverage * len(template) - 1e-9
        if full:
            yield start + a, start + z, matched
            numbers[start + a : start + z + 1] = 0
        if full or not whole or last == len(hits) and high - low <= 2 * band:
            # Hits inside a match are used up; a piece without one has nothing at its first hits' place.
            kept = [x for x in hits[:last] if not start + a <= x[1] <= start + z] if matched else []
            hits = (kept if full or len(kept) < last else kept[1:]) + hits[last:]
        whole = False


def scanner(templates: dict[str, str], scan: Scan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates, scan)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                found = [(k, *m) for k, t in enumerate(part.column(1).to_pylist()) if t for m in scan_text(t, index)]
                columns = list(zip(*found, strict=True)) or [[]] * 6
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
                ids = part.column(0).take(pa.array(columns[0], pa.int64()))
                names = ["doc_id", "license", "start", "end", "matched_words", "coverage"]
                yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, k) for c, k in zip(columns[1:], kinds, strict=True)]], names)

    return run


def read_templates(spark: SparkSession, path: str) -> DataFrame:
    """(license, text) of whole license texts, one per file below ``path``; the license is the file's name without ending."""
    name = F.regexp_replace(F.element_at(F.split(F.input_file_name(), "/"), -1), r"\.[^.]*$", "")
    return spark.read.text(path, wholetext=True).select(F.url_decode(name).alias("license"), F.col("value").alias("text"))


def template_texts(templates: dict[str, str] | DataFrame | None, scan: Scan) -> dict[str, str]:
    """The templates as a map; those of a table (license, text) are brought to the driver if they are few enough."""
    if not isinstance(templates, DataFrame):
        return TEMPLATES if templates is None else templates
    rows = templates.select("license", F.coalesce("text", F.lit("")).alias("text")).where("license IS NOT NULL")
    # A word has a letter at least, so texts within the bound on words are few characters, but for odd ones.
    size = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    if size > 64 * scan.most_words:
        raise ValueError(f"templates have {size} characters; split them into several scans")
    return {f"{r['license']}": r["text"] for r in rows.dropDuplicates(["license", "text"]).orderBy("license", "text").collect()}


def license_report(docs: DataFrame, templates: dict[str, str] | DataFrame | None = None, scan: Scan = Scan()) -> DataFrame:  # noqa: B008
    """doc_id, license, start, end, matched_words, coverage: a row per match in ``docs`` (doc_id, text).

    ``templates``: names and texts, or a table (license, text) such as ``read_templates`` gives; notices by default.
    NULL and empty texts match nothing, an empty table gives no rows, very long texts are scanned whole. A text with
    several notices has several rows, repeated rows of the table are looked at one by one. NULL ids stay; other
    columns are ignored. Templates without words match nothing; of several texts under one name the last by text counts.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {kind}, license string, start bigint, end bigint, matched_words bigint, coverage double"
    return docs.select("doc_id", "text").mapInArrow(scanner(template_texts(templates, scan), scan), fields)
