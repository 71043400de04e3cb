"""Token-ID files under Re-Pair grammars.

Documents are encoded by a public tokenizer, each followed by an end id, and written in ascending id order as blocks
of about a million ids. A block's grammar comes from Re-Pair in rounds: all pairs of neighbours are counted, the
frequent ones become nonterminals, and every occurrence that no more frequent pair overlaps is replaced; rounds
repeat until one shortens the sequence by less than three percent, so a symbol may stand for as long a passage as
repeats. A pair is frequent if it occurs four times and in 1/65,536 of all places. A block stores the shortened
sequence, the rules (two symbols each) and every rule's expansion length, so that any stretch of ids is decoded from
the few symbols that cover it.

The files are Parquet: a row and a row group per block, written by Spark's committer, so a lost executor costs a task
and no more. ``read_documents`` looks ids up in the narrow columns, reads the blocks that hold them and decodes
nothing but the symbols that cover them.

Encoding looks at the distinct pieces between spaces of a portion of texts: words of Latin letters, with or without a
full stop or comma, share the ids of their small letters, the others come from the memo of pieces. The ids of a text
are gathered by piece numbers, so an occurrence costs no Python call.

Scale: encoding is a map; the encoded rows are stored once, because a range partitioning reads them twice, and
shuffled once by (id, hash), so that a repeated id is spread as well. A task holds one block at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart.llm.native import same
from tallymart.llm.units import memo, word_ids
from tallymart.llm.units import tokenizer as load
from tallymart.session import scratch_path, stable

BLOCK = 1 << 20
SLICE = 256
TABLE = 18
#: Bytes of text whose distinct pieces are encoded together; a longer text is taken alone.
PORTION = 1 << 25
#: A word of letters that fold one by one and stand in no composition, with a full stop or comma or without.
PLAIN = "^[A-Za-zÀ-ÖØ-öø-ÿ]+[.,]?$"
#: Bytes of a row group: no more than one block, so that blocks are skipped by their numbers.
ROW_GROUP = 1 << 20
#: Blocks that are asked for by number; more are joined.
NAMED = 2000
NEVER = np.int32(2**31 - 1)
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def repair(ids: np.ndarray, first: int, least: int = 4, enough: float = 0.97) -> tuple[np.ndarray, np.ndarray]:
    """The shortened sequence and the rules (n x 2); nonterminals count up from ``first``, above every id."""
    s, rules, number = ids.astype(np.int64), [], first
    while len(s) >= 2 * least:
        pair = (s[:-1] << 32) | s[1:]
        cell = ((pair.view(np.uint64) * SPREAD) >> np.uint64(64 - TABLE)).astype(np.int64)
        # One pair stands for each cell of the table, so counts are exact; others of the cell wait for a later round.
        chosen = np.zeros(1 << TABLE, np.int64)
        chosen[cell] = pair
        counted = chosen[cell] == pair
        count = np.bincount(cell[counted], minlength=1 << TABLE)
        cells = np.flatnonzero(count >= max(least, len(s) >> 16))
        if not len(cells):
            break
        cells = cells[np.lexsort((cells, -count[cells]))]  # ties by cell, so neighbours rank at random
        rank = np.full(1 << TABLE, NEVER, np.int32)
        rank[cells] = np.arange(len(cells), dtype=np.int32)
        order = np.where(counted, rank[cell], NEVER)
        left, right = np.concatenate(([NEVER], order[:-1])), np.concatenate((order[1:], [NEVER]))
        taken = (order < NEVER) & (left > order) & (right >= order)
        used = np.bincount(order[taken], minlength=len(cells))
        taken &= (used >= least)[np.minimum(order, len(cells) - 1)]
        kept = np.flatnonzero(used >= least)
        if not len(kept):
            break
        symbol = np.zeros(len(cells), np.int64)
        symbol[kept] = number + np.arange(len(kept))
        found = chosen[cells[kept]]
        rules.append(np.column_stack((found >> 32, found & 0xFFFFFFFF)))
        number += len(kept)
        places = np.flatnonzero(taken)
        s = s.copy()
        s[places] = symbol[order[places]]
        before, keep = len(s), np.ones(len(s), bool)
        keep[places + 1] = False
        s = s[keep]
        if len(s) > enough * before:
            break
    return s, np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)


def expansion_lengths(rules: np.ndarray, first: int) -> np.ndarray:
    """How many ids each rule stands for; a rule only uses earlier symbols."""
    size = np.ones(len(rules), np.int64)
    known = 0
    while known < len(rules):  # all rules of a round hang on earlier rounds
        part = rules[known:]
        ready = int(np.argmax((part >= first + known).any(axis=1))) if (part >= first + known).any() else len(part)
        ready = max(ready, 1)
        some = part[:ready]
        size[known : known + ready] = np.where(some >= first, size[np.maximum(some - first, 0)], 1).sum(axis=1)
        known += ready
    return size


def expand(s: np.ndarray, rules: np.ndarray, first: int) -> np.ndarray:
    """The ids that a sequence of symbols stands for, all symbols one level per pass."""
    s, rules = s.astype(np.int32), rules.astype(np.int32)
    while True:
        inner = s >= first
        if not inner.any():
            return s
        ends = np.cumsum(1 + inner)
        out = np.empty(int(ends[-1]), np.int32)
        out[ends - 1 - inner] = np.where(inner, rules[np.where(inner, s - first, 0), 0], s)
        out[ends[inner] - 1] = rules[s[inner] - first, 1]
        s = out


def between(s: np.ndarray, rules: np.ndarray, size: np.ndarray, first: int, low: int, high: int) -> np.ndarray:
    """The ids from ``low`` up to ``high`` of a block, decoding only the symbols that cover them."""
    if high <= low:
        return np.zeros(0, np.int64)
    ends = np.cumsum(np.where(s >= first, size[np.maximum(s - first, 0)] if len(size) else 1, 1))
    a, b = np.searchsorted(ends, [low, high - 1], side="right")
    before = int(ends[a - 1]) if a else 0
    return expand(s[a : b + 1], rules, first)[low - before : high - before]


def width_of(symbols: int) -> str:
    """Little-endian numbers of two bytes where they are enough, else of four."""
    return "<u2" if symbols <= 1 << 16 else "<u4"


def portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch (doc_id, text) of ``PORTION`` bytes of text, or of one row."""
    ends, at = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64), 0
    while at < batch.num_rows:
        limit = (ends[at - 1] if at else 0) + PORTION
        upto = max(at + 1, int(np.searchsorted(ends, limit, side="right")))
        yield batch.slice(at, upto - at)
        at = upto


def spliced(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Stretches of ``flat`` end to end."""
    ends = np.cumsum(sizes)
    at = np.repeat(starts - (ends - sizes), sizes)
    return flat[at + np.arange(len(at))]


def piece_ids(pieces: pa.Array, path: str, width: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of distinct pieces end to end, and how many each has."""
    known, kind = memo(path, "H" if width == "<u2" else "I", fold=True), np.dtype(width)
    plain = pc.match_substring_regex(pieces, PLAIN)
    written = pieces.filter(plain)
    words = pc.utf8_lower(pc.utf8_rtrim(written, ".,")).dictionary_encode()
    ids, sizes = word_ids(path, words.dictionary)
    odd = pieces.filter(pc.invert(plain)).to_pylist()
    others = [*map(known.learn(odd), odd), known.tails["."], known.tails[","], b""]
    flat = np.concatenate((ids.astype(kind), np.frombuffer(b"".join(others), kind)))
    sizes = np.concatenate((sizes, [len(x) // kind.itemsize for x in others])).astype(np.int64)
    # A piece is a word and what follows it, or an odd piece and nothing.
    stop, comma, nothing = len(sizes) - 3, len(sizes) - 2, len(sizes) - 1
    is_plain, parts = plain.to_numpy(zero_copy_only=False), np.full((len(pieces), 2), nothing)
    ends = (pc.ends_with(written, c).to_numpy(zero_copy_only=False) for c in ".,")
    parts[is_plain, 0] = words.indices.to_numpy(zero_copy_only=False)
    parts[is_plain, 1] = np.select([*ends], [stop, comma], nothing)
    parts[~is_plain, 0] = len(words.dictionary) + np.arange(len(odd))
    of = sizes[parts]
    return spliced(flat, (np.cumsum(sizes) - sizes)[parts.ravel()], of.ravel()), of.sum(axis=1)


def encoder(path: str, end_id: int, width: str):
    """A map of Arrow batches (doc_id, text) to (doc_id, ids)."""
    size = np.dtype(width).itemsize

    def portion(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = pc.fill_null(part.column(1), "")
        # White space never enters a token of this tokenizer, so it is a boundary wherever it stands.
        for c in "\n\t\r":
            texts = pc.replace_substring(texts, c, " ")
        split = pc.split_pattern(texts, " ")
        begin = np.concatenate(([0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False), dtype=np.int64)))
        found = split.flatten().dictionary_encode()
        del texts, split
        numbers, end = found.indices.to_numpy(zero_copy_only=False), len(found.dictionary)
        flat, sizes = piece_ids(found.dictionary, path, width)
        flat, sizes = np.append(flat, np.array([end_id], flat.dtype)), np.append(sizes, 1)
        starts = np.cumsum(sizes) - sizes
        for at in range(0, part.num_rows, SLICE):
            some = part.slice(at, SLICE)
            stops = begin[at + 1 : at + 1 + some.num_rows] - begin[at]
            each = np.insert(numbers[begin[at] : begin[at] + stops[-1]], stops, end)
            ids = spliced(flat, starts[each], sizes[each])
            bounds = np.concatenate(([0], np.cumsum(sizes[each])[stops + np.arange(len(stops))])) * size
            if bounds[-1] >= 1 << 31:
                raise ValueError("the ids of a slice of texts take more than 2 GB")
            data = [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(ids)]
            yield pa.RecordBatch.from_arrays([some.column(0), pa.Array.from_buffers(pa.binary(), some.num_rows, data)], ["doc_id", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch):
                yield from portion(part)

    return run


def packed(first: int, kind: pa.DataType, width: str):
    """A map of ordered (doc_id, ids) to blocks."""
    size = np.dtype(width).itemsize

    def block(part: int, number: int, docs: list, ids: list[bytes]) -> pa.RecordBatch:
        whole = np.frombuffer(b"".join(ids), width)
        s, rules = repair(whole, first)
        symbols = width_of(first + len(rules))
        row = {
            "part": pa.array([part], pa.int32()),
            "block": pa.array([number], pa.int32()),
            "doc_ids": pa.array([docs], pa.list_(kind)),
            "lengths": pa.array([[len(x) // size for x in ids]], pa.list_(pa.int32())),
            "n_ids": pa.array([len(whole)], pa.int64()),
            "first_rule": pa.array([first], pa.int32()),
            "width": pa.array([symbols], pa.string()),
            "rules": pa.array([rules.astype(symbols).tobytes()], pa.binary()),
            "rule_lengths": pa.array([expansion_lengths(rules, first).astype("<u4").tobytes()], pa.binary()),
            "sequence": pa.array([s.astype(symbols).tobytes()], pa.binary()),
        }
        return pa.RecordBatch.from_arrays(list(row.values()), list(row))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, docs, ids, held = TaskContext.get().partitionId(), 0, [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                some = batch.slice(at, SLICE)
                for doc, x in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                    docs.append(doc)
                    ids.append(x)
                    held += len(x)
                    if held >= size * BLOCK:
                        yield block(part, number, docs, ids)
                        number, docs, ids, held = number + 1, [], [], 0
        if docs:
            yield block(part, number, docs, ids)

    return run


def write_ids(docs: DataFrame, tokenizer: str, path: str, end_id: int = 1) -> None:
    """Write the token ids of ``docs`` (doc_id, text) as Re-Pair blocks in ascending id order, NULL first.

    NULL and empty texts have the end id alone; rows with equal ids go by a hash of their ids. Other columns are
    ignored. An empty table writes files without blocks. The tokenizer must drop white space and fold case.
    """
    first_rule = load(tokenizer).get_vocab_size()
    width = width_of(first_rule)
    kind = docs.schema["doc_id"].dataType
    encoded = stable(docs.select("doc_id", "text").mapInArrow(encoder(tokenizer, end_id, width), f"doc_id {kind.simpleString()}, ids binary"))
    from pyspark.sql.pandas.types import to_arrow_type

    keyed = encoded.withColumn("tie", F.xxhash64("ids"))
    ordered = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "ids").select("doc_id", "ids")
    fields = f"doc_ids array<{kind.simpleString()}>, lengths array<int>, n_ids bigint, first_rule int, width string"
    blocks = ordered.mapInArrow(packed(first_rule, to_arrow_type(kind), width), f"part int, block int, {fields}, rules binary, rule_lengths binary, sequence binary")
    blocks.write.option("parquet.block.size", ROW_GROUP).parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            docs, lengths, offset, first, width, rules, s = (row.column(i)[0].as_py() for i in range(7))
            ids = expand(np.frombuffer(s, width).astype(np.int64), np.frombuffer(rules, width).astype(np.int64).reshape(-1, 2), first)
            data = memoryview(ids.astype("<u4").tobytes())
            ends = np.cumsum(lengths)
            starts = ends - lengths
            crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            arrays = [pa.array(docs, batch.schema.field(0).type.value_type), pa.array(starts + offset), pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, decoded from the files.

    Positions come from a running sum over the parts, a row each, and one inside each part, a row per block.
    """
    blocks = spark.read.parquet(path)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    sizes = blocks.select("part", "block", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    ahead = F.sum("ids").over(Window.partitionBy(F.lit(0)).orderBy("part")) - F.col("ids")
    inner = F.sum("n_ids").over(Window.partitionBy("part").orderBy("block")) - F.col("n_ids")
    offsets = sizes.withColumn("inner", inner).join(parts.select("part", ahead.alias("ahead")), "part")
    offsets = stable(offsets.select(F.col("part").alias("p"), F.col("block").alias("b"), (F.col("inner") + F.col("ahead")).alias("offset")).coalesce(1))
    rows = blocks.join(offsets, same(F.col("part"), F.col("p")) & same(F.col("block"), F.col("b")))
    rows = rows.select("doc_ids", "lengths", "offset", "first_rule", "width", "rules", "sequence")
    return rows.mapInArrow(_read, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            first, width, rules, lengths, s, asked = (batch.column(i)[k].as_py() for i in range(6))
            rules, s = (np.frombuffer(x, width).astype(np.int64) for x in (rules, s))
            rules, size = rules.reshape(-1, 2), np.frombuffer(lengths, "<u4").astype(np.int64)
            found = [between(s, rules, size, first, a["low"], a["high"]).astype("<u4").tobytes() for a in asked]
            kind = batch.schema.field(5).type.value_type.field("doc").type
            yield pa.RecordBatch.from_arrays([pa.array([a["doc"] for a in asked], kind), pa.array(found, pa.binary())], ["doc_id", "ids"])


def read_documents(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """(doc_id, ids as little-endian numbers of four bytes, the end id last) of the documents in ``wanted`` (doc_id).

    Documents that are not in the files have no row, repeated ids in the files a row each; a NULL id asks for
    documents without one. Where the documents lie in no more than ``NAMED`` blocks, only these are read.
    """
    blocks = spark.read.parquet(path)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    ids = wanted.select(F.col("doc_id").cast(kind).alias("asked_id")).distinct()
    each = blocks.select("part", "block", F.posexplode(F.arrays_zip("doc_ids", "lengths")).alias("at", "held"))
    each = each.select("part", "block", "at", F.col("held.doc_ids").alias("doc"), F.col("held.lengths").cast("bigint").alias("n"))
    high = F.sum("n").over(Window.partitionBy("part", "block").orderBy("at"))
    placed = each.select("part", "block", "doc", "n", high.alias("high"))
    placed = placed.join(ids, same(F.col("doc"), F.col("asked_id")), "left_semi")
    asked = F.collect_list(F.struct("doc", (F.col("high") - F.col("n")).alias("low"), "high")).alias("asked")
    places = stable(placed.groupBy("part", "block").agg(asked))
    named = places.select("part", "block").limit(NAMED + 1).collect()
    if len(named) <= NAMED:
        numbers: dict[int, list[int]] = {}
        for row in named:
            numbers.setdefault(row["part"], []).append(row["block"])
        some = [(F.col("part") == p) & F.col("block").isin(b) for p, b in numbers.items()]
        blocks = blocks.where(reduce(or_, some, F.lit(False)))
    rows = blocks.join(places.withColumnsRenamed({"part": "p", "block": "b"}), (F.col("part") == F.col("p")) & (F.col("block") == F.col("b")))
    rows = rows.select("first_rule", "width", "rules", "rule_lengths", "sequence", "asked")
    return rows.mapInArrow(_covered, f"doc_id {kind}, ids binary")


def grammar_report(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write the files below the shared folder and read every document back from them."""
    path = scratch_path(docs.sparkSession, "token-ids")
    write_ids(docs, tokenizer, path, end_id)
    return read_report(docs.sparkSession, path)
