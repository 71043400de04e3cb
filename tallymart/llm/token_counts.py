"""Token counts of whole texts; huge ones by overlapping chunks that are spliced where both encodings must agree.

A byte-level BPE first cuts a text by a pattern. Where a single space stands between two characters that are no
white space, the pattern starts a new piece at the space, whatever stands further left or right; no merge and no
special token crosses it. Such a position is a stable boundary.

Texts up to ``chunk`` characters are cut at their stable boundaries into pieces whose counts are remembered; ASCII
letters and a closing full stop or comma are two pieces for the pattern. Longer
ones are encoded in chunks with offsets; each overlaps the one before. The splice is a stable boundary inside the
overlap at which both encodings start a token. If the overlap has none, it is widened, doubling, back to the start
of the open chunk; then both are encoded as one. Memory is bounded by the chunk unless a text has no boundary at all.

Scale: a map over the scan, nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallymart.llm.units import memo, tokenizer

BOUNDARY = re.compile(r"(?<=\S) (?=\S)")
SLICE = 128


@dataclass(frozen=True)
class Chunks:
    chunk: int = 16_384
    overlap: int = 512


def starts(path: str, text: str, at: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and first characters (in the whole text) of the tokens of ``text[at:end]``."""
    found = tokenizer(path).encode(text[at:end], add_special_tokens=False)
    return np.array(found.ids, np.int64), np.array([a for a, _ in found.offsets], np.int64) + at


def splice(text: str, low: int, high: int, left: np.ndarray, right: np.ndarray) -> int | None:
    """The middle stable boundary inside ``text[low:high]`` at which both encodings start a token."""
    places = [m.start() + low for m in BOUNDARY.finditer(text[low:high])]
    common = np.intersect1d(np.intersect1d(places, left), right)
    return int(common[len(common) // 2]) if len(common) else None


def encode_long(path: str, text: str, chunks: Chunks) -> Iterator[np.ndarray]:
    """The ids of the whole text, part by part."""
    at, end = 0, min(chunks.chunk, len(text))
    ids, first = starts(path, text, at, end)
    while end < len(text):
        overlap = min(chunks.overlap, end - at)
        while True:
            low = end - overlap
            next_end = min(low + max(chunks.chunk, 2 * overlap), len(text))
            next_ids, next_first = starts(path, text, low, next_end)
            place = splice(text, low, end, first, next_first)
            if place is not None or low == at:
                break
            overlap = min(2 * overlap, end - at)
        if place is not None:
            yield ids[first < place]
            at = place
            ids, first = next_ids[next_first >= place], next_first[next_first >= place]
        else:  # no boundary at all: the open part and the next become one
            ids, first = next_ids, next_first
        end = next_end
    yield ids


def count_long(path: str, text: str, chunks: Chunks) -> int:
    return sum(len(part) for part in encode_long(path, text, chunks))


def counts(path: str, chunks: Chunks):
    """A map of Arrow batches (doc_id, text) to (doc_id, n_bytes, n_tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inner, head = memo(path, "count", " "), memo(path, "count")
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                texts = [t or "" for t in part.column(1).to_pylist()]
                pieces = [BOUNDARY.split(t) if len(t) <= chunks.chunk else None for t in texts]
                first = head.learn(p[0] for p in pieces if p)
                other = inner.learn(chain.from_iterable(p[1:] for p in pieces if p))
                n = [
                    first(p[0]) + sum(map(other, p[1:])) if p else count_long(path, t, chunks)
                    for t, p in zip(texts, pieces, strict=True)
                ]
                sizes = [len(t.encode()) for t in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return run


def token_report(docs: DataFrame, path: str, limit: int = 1024, chunks: Chunks = Chunks()) -> DataFrame:  # noqa: B008
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs`` (doc_id, text).

    NULL and empty texts have no bytes and no tokens. Special strings in a text count as the library's default
    says. NULL or repeated ids stay as they are. Other columns are ignored. ``path`` is a byte-level BPE file that
    every worker can read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(counts(path, chunks), f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return found.withColumn("over_limit", found.n_tokens > limit)
