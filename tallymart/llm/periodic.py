"""Periodic runs of words, by internal pattern matching.

A run is a stretch of words that repeats with a smallest period q and is at least ``times`` periods long. With B the
power of two at or below q, the run holds an aligned block of B words near its start, and the block occurs again q
words on. So every aligned block of every size B asks for its occurrences that start B to 2B - 1 words after it:
range successors over the stretch of the suffix array whose suffixes begin with the block, answered by a wavelet
tree. One or two occurrences are candidate periods themselves. Three or more are an arithmetic progression, and its
difference p is a period of the block; then only one distance can be a smallest period, the one that carries the end of the
p-periodic stretch around the block to the end of the one around the progression, and none if both are one stretch.
A candidate is extended in both directions over the names of dyadic substrings, which refining the suffix array leaves
behind; what stays long enough is a run, and of several periods of one stretch the smallest counts.

Scale: a map over the scan, nothing is shuffled. Documents go through the arrays together until they have ``GROUP``
words; words of different documents never match, so memory is bounded by that or by one document, times the
logarithm of the longest repeated stretch, and the time is near to linear in the words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words that go through the arrays together.
GROUP = 1 << 16
SLICE = 4096


@dataclass(frozen=True)
class Periodic:
    """A run has at least ``least`` words and ``times`` periods; the blocks need four periods or more."""

    least: int = 6
    times: int = 4

    def __post_init__(self) -> None:
        if self.times < 4:
            raise ValueError("shorter runs need not hold an aligned block and its next occurrence")


class Wavelet:
    """A wavelet tree over numbers in [0, n): per bit, how many of the first i numbers have it set."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, (len(values) - 1).bit_length())
        self.words, self.before, self.zeros = [], [], []
        for bit in range(self.bits - 1, -1, -1):
            ones = (values >> bit & 1).astype(bool)
            packed = np.zeros((len(values) >> 6) * 8 + 8, np.uint8)
            some = np.packbits(ones, bitorder="little")
            packed[: len(some)] = some
            words = packed.view(np.uint64)
            self.words.append(words)
            self.before.append(np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64))))
            self.zeros.append(len(values) - int(ones.sum()))
            values = np.concatenate((values[~ones], values[ones]))

    def ones(self, level: int, upto: np.ndarray) -> np.ndarray:
        word = upto >> 6
        mask = (np.uint64(1) << (upto & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[level][word] + np.bitwise_count(self.words[level][word] & mask)

    def successor(self, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """For each query the smallest value of ``[low, high)`` that is at least ``least``; -1 if there is none."""
        a, b, smaller = low, high, np.zeros(len(low), np.int64)
        for level in range(self.bits):
            one = (least >> (self.bits - 1 - level) & 1).astype(bool)
            a1, b1 = self.ones(level, a), self.ones(level, b)
            smaller += np.where(one, (b - b1) - (a - a1), 0)
            a, b = (np.where(one, self.zeros[level] + x1, x - x1) for x, x1 in ((a, a1), (b, b1)))
        wanted, found = smaller, np.zeros(len(low), np.int64)
        missing = (wanted >= high - low) | (least >> self.bits > 0)
        a, b, wanted = low, high, np.where(missing, 0, wanted)
        for level in range(self.bits):
            a1, b1 = self.ones(level, a), self.ones(level, b)
            zeros = (b - b1) - (a - a1)
            one = wanted >= zeros
            wanted = np.where(one, wanted - zeros, wanted)
            found |= one.astype(np.int64) << (self.bits - 1 - level)
            a, b = (np.where(one, self.zeros[level] + x1, x - x1) for x, x1 in ((a, a1), (b, b1)))
        return np.where(missing, -1, found)


class Suffixes:
    """The suffix array of a sequence of symbols, sorted by the first 2^k of them for k = 0, 1, ... until substrings
    are all different or ``longest`` is reached. ``names[k]`` is where the substrings of 2^k symbols that begin at a
    position stand in the array, so equal names are equal substrings."""

    def __init__(self, symbols: np.ndarray, longest: int) -> None:
        self.n = len(symbols)
        self.array = np.argsort(symbols, kind="stable")
        ordered = symbols[self.array]
        first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        name = np.empty(self.n, np.int64)
        name[self.array] = np.repeat(first, np.diff(np.append(first, self.n)))
        self.names, self.sizes = [name], [np.bincount(name, minlength=self.n)]
        while 2 << (k := len(self.names) - 1) <= longest:
            slots = np.flatnonzero(self.sizes[k][name[self.array]] > 1)
            if not len(slots):
                break
            at = self.array[slots]
            later = at + (1 << k)
            second = np.where(later < self.n, name[np.minimum(later, self.n - 1)], -1)
            order = np.lexsort((second, name[at]))
            at, left, right = at[order], name[at][order], second[order]
            new = np.concatenate(([True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])))
            first = np.flatnonzero(new)
            self.array[slots] = at
            name = name.copy()
            name[at] = np.repeat(slots[first], np.diff(np.append(first, len(slots))))
            self.names.append(name)
            self.sizes.append(np.bincount(name, minlength=self.n))

    def after(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How far the symbols from i on equal those from j on, i < j."""
        return self._common(i, j, 1)

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How far the symbols before i equal those before j, i < j."""
        return self._common(i, j, -1)

    def _common(self, i: np.ndarray, j: np.ndarray, side: int) -> np.ndarray:
        far = np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            name, open_ = self.names[k], np.arange(len(i))
            back = 1 << k if side < 0 else 0
            while len(open_):
                a, b = i[open_] + side * far[open_] - back, j[open_] + side * far[open_] - back
                inside = (a >= 0) & (b + (1 << k) <= self.n)
                open_, a, b = open_[inside], a[inside], b[inside]
                open_ = open_[name[a] == name[b]]
                far[open_] += 1 << k
                if k < len(self.names) - 1:
                    break  # twice the length is different, so this length fits once at most
        return far


def candidates(suffixes: Suffixes, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(block, period) to be tried; ``end`` is where the document of a position ends."""
    tree = Wavelet(suffixes.array)
    blocks, periods = [], []
    for k, (name, size) in enumerate(zip(suffixes.names, suffixes.sizes, strict=True)):
        width = 1 << k
        i = np.arange(0, suffixes.n, width)
        i = i[(size[name[i]] > 1) & (i + 2 * width <= end[i])]
        low, high = name[i], name[i] + size[name[i]]
        near = [tree.successor(low, high, i + width)]
        for _ in range(2):
            held = np.flatnonzero((near[-1] >= 0) & (near[-1] < i + 2 * width))
            following = np.full(len(i), -1)
            if len(held) and k:  # the window of single words has one place
                following[held] = tree.successor(low[held], high[held], near[-1][held] + 1)
            near.append(following)
        x, y, z = (np.where((0 <= p) & (p < i + 2 * width), p, -1) for p in near)
        alone = (z < 0) & (x >= 0)
        two = alone & (y >= 0)
        blocks += [i[alone], i[two]]
        periods += [(x - i)[alone], (y - i)[two]]
        many = np.flatnonzero(z >= 0)
        if len(many):
            i, x, p = i[many], x[many], (y - x)[many]
            here = i + p + suffixes.after(i, i + p)
            there = x + p + suffixes.after(x, x + p)
            apart = (here < x + width) & (there - here >= width) & (there - here < 2 * width)
            blocks.append(i[apart])
            periods.append((there - here)[apart])
    return np.concatenate(blocks), np.concatenate(periods)


def runs_of(sequences: list[list[bytes]], how: Periodic = Periodic()) -> list[np.ndarray]:  # noqa: B008
    """Per sequence the runs as rows (start, length, period), by start, then period."""
    lengths = np.array([len(s) for s in sequences], np.int64)
    ends = np.cumsum(lengths)
    n = int(lengths.sum())
    nothing = np.zeros((0, 3), np.int64)
    if n < how.least:
        return [nothing] * len(sequences)
    known = {w: k for k, w in enumerate(set().union(*sequences))}
    words = np.fromiter((known[w] for s in sequences for w in s), np.int64, n)
    doc = np.repeat(np.arange(len(sequences)), lengths)
    suffixes = Suffixes(doc * len(known) + words, max(1, int(lengths.max()) // how.times))
    i, q = candidates(suffixes, ends[doc])
    start = i - suffixes.before(i, i + q)
    stop = i + q + suffixes.after(i, i + q)
    good = stop - start >= np.maximum(how.least, how.times * q)
    start, stop, q = start[good], stop[good], q[good]
    order = np.lexsort((q, stop, start))
    start, stop, q = start[order], stop[order], q[order]
    new = np.concatenate(([True], (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])))[: len(start)]
    start, stop, q = start[new], stop[new], q[new]
    order = np.lexsort((q, start))
    start, stop, q = start[order], stop[order], q[order]
    cut = np.searchsorted(start, np.concatenate(([0], ends)))
    rows = np.column_stack((start, stop - start, q))
    return [rows[a:b] - [int(e - m), 0, 0] for a, b, e, m in zip(cut, cut[1:], ends, lengths, strict=False)]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by one space, of each run only its first period."""
    if len(runs):
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, runs[:, 0] + runs[:, 2], 1)
        np.add.at(change, runs[:, 0] + runs[:, 1], -1)
        words = list(compress(words, (np.cumsum(change)[:-1] == 0).tolist()))
    return b" ".join(words)


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def scanner(how: Periodic):
    """A map of Arrow batches (doc_id, text) to (doc_id, runs, collapsed)."""

    def made(ids: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
        found = runs_of(texts, how)
        rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
        offsets = np.concatenate(([0], np.cumsum([len(r) for r in found]))).astype(np.int32)
        fields = pa.StructArray.from_arrays([pa.array(rows[:, c]) for c in range(3)], fields=list(RUN))
        short = pa.array([collapsed(w, r).decode("utf-8", "replace") for w, r in zip(texts, found, strict=True)], pa.string())
        return pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(offsets), fields), short], ["doc_id", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, texts, held = 0, [], 0
            for k in range(batch.num_rows):
                texts.append((batch.column(1)[k].as_py() or "").encode().split())
                held += len(texts[-1])
                if held >= GROUP or len(texts) == SLICE or k + 1 == batch.num_rows:
                    yield made(batch.column(0).slice(at, len(texts)), texts)
                    at, texts, held = k + 1, [], 0

    return run


def periodic_runs(docs: DataFrame, how: Periodic = Periodic()) -> DataFrame:  # noqa: B008
    """doc_id, runs (array of start, length, period), collapsed for every row of ``docs`` (doc_id, text).

    Words are what stands between ASCII white space, numbered from 0. Runs cannot be lengthened without losing their
    smallest period; they ascend by start, then period. ``collapsed`` is the text without the words that stand in
    any run after its first period. NULL and empty texts have no words and collapse to the empty text. Very long
    texts go through whole. NULL or repeated ids stay as they are, an empty table gives no rows, other columns are
    ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    runs = "array<struct<start:bigint,length:bigint,period:bigint>>"
    return docs.select("doc_id", "text").mapInArrow(scanner(how), f"doc_id {kind}, runs {runs}, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text; in one of ten documents, by the checksum of the id, the words from some place on repeat those that follow it.

    With h the checksum, g = h // 10 and n words, a document with h a multiple of 10 gets from word a = g % n on the
    1 + (n - a) // (3 + g % 8) words from there again and again. Texts without words and NULL ids stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(w):
        n = F.size(w).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        each = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
        return F.when(n > 0, F.concat_ws(" ", each))

    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    # Inside the outer transform the words are an argument, worked out once per text.
    changed = F.get(F.transform(F.array(words), repeated), F.lit(0))
    return docs.select("doc_id", F.coalesce(F.when(h % 10 == 0, changed), F.col("text")).alias("text"))


def run_report(docs: DataFrame, how: Periodic = Periodic()) -> DataFrame:  # noqa: B008
    """doc_id, n_runs, the run of the greatest exponent and digests for every row of ``docs`` (doc_id, text).

    start, length, period and exponent_milli are those of the run with the greatest length / period, the first of
    several, and NULL without runs. runs_sha256 is over a line ``start,length,period`` per run, collapsed_sha256
    over the collapsed text.
    """
    found = periodic_runs(docs, how)
    first = F.get("runs", F.lit(0))
    more = lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a)
    best = F.reduce("runs", first, more)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    rows = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.alias("best"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    length, period = F.col("best")["length"], F.col("best")["period"]
    return rows.select(
        "doc_id",
        "n_runs",
        F.col("best")["start"].alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
