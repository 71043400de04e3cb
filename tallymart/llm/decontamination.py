"""Benchmark decontamination by size-partitioned MinHash containment search (native).

Test items are short and documents long, so their Jaccard similarity says little; what counts is the share of an
item's shingles that the document holds. An item's sketch is the least of its hashed shingles: as many as a document
may lack at the wanted containment, and ``spare`` more. So a document that contains the item shares at least ``spare``
values of its sketch, whichever it lacks, and no match is lost to the sketch; candidates with fewer hits are no match.

Items are partitioned by the size of their shingle set (powers of two). The larger the items, the smaller the part
of the hash range in which their sketches lie; a partition's bound is its largest sketch value. A document asks the
partitions whose items it is large enough to contain, with those of its hashes that lie below the largest of their
bounds; its other hashes meet nothing. Candidates are verified on exact shingle sets.

Scale: document hashes are made and met with the sketch index inside the scan as long as the index is small enough
for Spark to broadcast; a larger benchmark is joined by a shuffle of hashes below the bound. Only hits are grouped,
and only candidates' texts are read again. Work grows with the documents, never with documents times items. The
driver holds a row per partition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.native import once, same, words
from tallymart.session import stable


@dataclass(frozen=True)
class Leaks:
    """Items match when at least ``containment`` of their ``shingle``-word shingles are in the document. ``spare`` hits
    make a candidate, or as many as a small item needs for a match."""

    shingle: int = 5
    containment: float = 0.8
    spare: int = 2

    @property
    def thousandths(self) -> int:
        return round(self.containment * 1000)


def shingles(w: str, k: int, build) -> Column:
    """``build`` of every run of ``k`` words; texts of fewer words have their whole sequence as one, empty ones none."""
    runs = F.transform(w, lambda x, i: build(*[F.get(w, i + j) for j in range(k)]))
    full = F.slice(runs, F.lit(1), F.greatest(F.size(w) - (k - 1), F.lit(0)))
    return F.when(F.size(w) >= k, full).when(F.size(w) > 0, F.slice(runs, F.lit(1), F.lit(1)))


def _hash(*parts: Column) -> Column:
    return F.xxhash64(*parts)


def _text(*parts: Column) -> Column:
    return F.concat_ws(" ", *parts)


def keyed_words(rows: DataFrame, key: str, name: str) -> DataFrame:
    """The id, a key of the row's text, and its words in lower case."""
    slim = rows.select(F.col(key).alias(name), F.xxhash64("text").alias("text_key"), F.lower("text").alias("text"))
    return words(slim)


def index(benchmark: DataFrame, leaks: Leaks) -> DataFrame:
    """The inverted index, stored: a row per sketch value of an item (hash, item, partition, hits wanted, set size)."""
    hashed = keyed_words(benchmark, "item_id", "item_id").dropDuplicates(["item_id", "text_key"])
    hashed = once(hashed, "hashes", F.array_sort(F.array_distinct(shingles("w", leaks.shingle, _hash))))
    size = F.size("hashes")
    enough = F.ceil(size * leaks.thousandths / 1000).cast("int")
    wanted = F.greatest(F.lit(1), F.least(F.lit(leaks.spare), enough))
    return stable(
        hashed.where(size > 0).select(
            "item_id",
            F.col("text_key").alias("item_key"),
            size.alias("item_shingles"),
            F.floor(F.log2(size)).cast("int").alias("part"),
            wanted.alias("wanted"),
            F.explode(F.slice("hashes", F.lit(1), size - enough + wanted)).alias("hash"),
        )
    )


def partitions(items: DataFrame) -> list[tuple[int, int, int]]:
    """(partition, size of its smallest item, bound) of an index, in order of size; at most one per power of two."""
    found = items.groupBy("part").agg(F.min("item_shingles").alias("least"), F.max("hash").alias("bound"))
    return sorted((r["part"], r["least"], r["bound"]) for r in found.collect())


def reach(size: Column, parts: list[tuple[int, int, int]], leaks: Leaks) -> Column:
    """The largest bound of the partitions whose smallest item a set of ``size`` shingles can contain; NULL if there is none."""
    able = [F.when(size * 1000 >= least * leaks.thousandths, F.lit(bound)) for _, least, bound in parts]
    return F.greatest(*able, F.lit(None).cast("bigint")) if able else F.lit(None).cast("bigint")


def probes(docs: DataFrame, parts: list[tuple[int, int, int]], leaks: Leaks) -> DataFrame:
    """(doc_id, text_key, doc_shingles, hash): the hashes with which documents ask the index."""
    sketches = keyed_words(docs, "doc_id", "doc_id")
    sketches = once(sketches, "hashes", F.array_distinct(shingles("w", leaks.shingle, _hash))).drop("w")
    size = F.size("hashes")
    sketches = sketches.select("doc_id", "text_key", size.alias("doc_shingles"), reach(size, parts, leaks).alias("limit"), F.explode("hashes").alias("hash"))
    return sketches.where(F.col("hash") <= F.col("limit")).drop("limit")


def candidates(docs: DataFrame, items: DataFrame, leaks: Leaks) -> DataFrame:
    """Pairs of a document row and an item whose sketch hits allow the wanted containment."""
    hits = probes(docs, partitions(items), leaks).join(items, "hash")
    hits = hits.where(F.col("doc_shingles") * 1000 >= F.col("item_shingles") * leaks.thousandths)
    found = hits.groupBy("doc_id", "text_key", "item_id", "item_key").agg(
        F.count_distinct("hash").alias("hits"), F.first("wanted").alias("wanted")
    )
    return found.where(F.col("hits") >= F.col("wanted")).drop("wanted")


def leak_report(docs: DataFrame, benchmark: DataFrame, leaks: Leaks = Leaks()) -> DataFrame:  # noqa: B008
    """doc_id, text_key, item_id, item_shingles, shared_shingles, containment: every verified pair, once.

    Texts are compared in lower case. Rows with equal id and text count once; rows that share an id but not the
    text are looked at one by one. NULL and empty texts, of documents and of items, match nothing; a text of fewer
    words than a shingle is one shingle. NULL ids are ids. Empty tables, of documents or of items, give no rows;
    very long texts are searched whole. Other columns are ignored.
    """
    pairs = stable(candidates(docs, index(benchmark, leaks), leaks))
    wanted = pairs.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).distinct()
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    texts = texts.join(wanted, same(F.col("doc_id"), F.col("id")) & (F.col("text_key") == F.col("key")), "left_semi")
    held = keyed_words(texts, "doc_id", "doc_id").dropDuplicates(["doc_id", "text_key"])
    held = held.select("doc_id", "text_key", F.array_distinct(shingles("w", leaks.shingle, _text)).alias("held"))
    asked = keyed_words(benchmark, "item_id", "b_id").dropDuplicates(["b_id", "text_key"])
    asked = asked.select("b_id", F.col("text_key").alias("b_key"), F.array_distinct(shingles("w", leaks.shingle, _text)).alias("asked"))
    held = held.withColumnsRenamed({"doc_id": "id", "text_key": "key"})
    sets = pairs.join(held, same(F.col("doc_id"), F.col("id")) & (F.col("text_key") == F.col("key"))).join(
        asked, same(F.col("item_id"), F.col("b_id")) & (F.col("item_key") == F.col("b_key"))
    )
    shared = F.size(F.array_intersect("held", "asked"))
    counted = sets.select(
        "doc_id", "text_key", "item_id", "item_key", F.size("asked").cast("long").alias("item_shingles"), shared.cast("long").alias("shared_shingles")
    )
    return (
        counted.where(F.col("shared_shingles") * 1000 >= F.col("item_shingles") * leaks.thousandths)
        .drop("item_key")
        .withColumn("containment", F.col("shared_shingles") / F.col("item_shingles"))
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, leaks: Leaks = Leaks()) -> DataFrame:  # noqa: B008
    """The rows of ``docs`` that hold no test item, all columns."""
    bad = stable(leak_report(docs, benchmark, leaks).select(F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key")).distinct())
    row = F.struct(*docs.columns).alias("whole_row")
    keyed = docs.select(row, "doc_id", F.xxhash64("text").alias("text_key"))
    kept = keyed.join(bad, same(F.col("doc_id"), F.col("bad_id")) & (F.col("text_key") == F.col("bad_key")), "left_anti")
    return kept.select(*[F.col("whole_row")[c].alias(c) for c in docs.columns])
