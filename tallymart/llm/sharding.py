"""Proportional stratified interleaving: every shard gets the mixture of sources.

Rows are shuffled by seed within their source and ranked; rank r of n stands at the fraction (r - 1 + phase) / n.
The phase is a number of the source's own in [0, 1): without it sources of one size would meet at every fraction.
Sorted by fraction, each stretch of the order holds every source in proportion, so the order is cut into shards
whose row counts differ by one at most.

Scale: neither a source nor the whole table is sorted in one task. Ranks come from counts of ranges: a row's rank
is the number of rows in the ranges before its own plus its place within the range, first over the random numbers
of a source, then over the fractions. The number of ranges follows the row count. The second set of counts is
derived from the first, so the rows themselves, with whatever they carry, are shuffled twice and stored nowhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.native import fresh, same, unit
from tallymart.session import stable


def row_bytes(docs: DataFrame):
    """Bytes of the text in UTF-8 (none for NULL) plus eight."""
    return (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long")


def interleave(docs: DataFrame, shards: int, seed: str = "shard", rows_per_range: int = 20_000) -> DataFrame:
    """The columns of ``docs`` (doc_id, text, source and any others) with shard, slot and the global position.

    Names that clash with a column of ``docs`` get an underscore. Ties of the random number (equal ids) go by id
    and text; equal rows are interchangeable. A NULL source is a source of its own. An empty table gives no rows.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    row, = fresh(docs, "whole_row")
    u = unit("doc_id", seed=seed)
    total = docs.count()
    ranges = -(-total // rows_per_range) or 1
    draw = docs.select("source", u.alias("u")).withColumn("range", F.floor(F.col("u") * ranges))
    counts = draw.groupBy("source", "range").agg(F.count(F.lit(1)).alias("rows"))
    by_source = Window.partitionBy("source")
    counts = stable(
        counts.withColumns(
            {
                "before": F.sum("rows").over(by_source.orderBy("range")) - F.col("rows"),
                "all_rows": F.sum("rows").over(by_source),
            }
        )
    )
    fraction = (F.col("rank") - 1 + unit("source", seed=f"{seed}-phase")) / F.col("all_rows")
    stretch = F.floor(F.col("fraction") * ranges)
    ranks = counts.select("source", "all_rows", F.explode(F.sequence(F.col("before") + 1, F.col("before") + F.col("rows"))).alias("rank"))
    stretches = ranks.withColumn("fraction", fraction).groupBy(stretch.alias("stretch")).agg(F.count(F.lit(1)).alias("rows"))
    ahead = F.sum("rows").over(Window.partitionBy(F.lit(0)).orderBy("stretch")) - F.col("rows")
    stretches = stable(stretches.select("stretch", ahead.alias("ahead")))

    rows = docs.select(F.struct(*docs.columns).alias(row), "source", "doc_id", F.crc32("text").alias("crc"), u.alias("u"))
    rows = rows.withColumn("range", F.floor(F.col("u") * ranges))
    known = counts.select(F.col("source").alias("s"), F.col("range").alias("g"), "before", "all_rows")
    place = F.row_number().over(Window.partitionBy("source", "range").orderBy("u", "doc_id", "crc"))
    ranked = (
        rows.join(known, same(F.col("source"), F.col("s")) & (F.col("range") == F.col("g")))
        .withColumn("rank", F.col("before") + place)
        .withColumn("fraction", fraction)
        .select(row, "source", "fraction", stretch.alias("stretch"))
    )
    inner = F.row_number().over(Window.partitionBy("stretch").orderBy("fraction", F.col("source").asc_nulls_last()))
    placed = ranked.join(stretches, "stretch").withColumn("position", F.col("ahead") + inner - 1)
    shard = F.expr(f"position * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {max(total, 1)} + {shards - 1}) div {shards}")
    names = fresh(docs, "shard", "slot", "position")
    return (
        placed.withColumn("shard", shard)
        .withColumn("slot", F.col("position") - first)
        .select(
            *[F.col(row)[c].alias(c) for c in docs.columns],
            F.col("shard").cast("int").alias(names[0]),
            F.col("slot").cast("long").alias(names[1]),
            F.col("position").cast("long").alias(names[2]),
        )
    )


def shard_report(docs: DataFrame, shards: int = 24, seed: str = "shard") -> DataFrame:
    """doc_id, source, size, text_crc32, law, shard, slot, grown_shard per row; texts stay in the scan.

    A NULL text has no bytes and the checksum of the empty text; the law is ``rows``.
    """
    slim = docs.select(
        "doc_id",
        "source",
        row_bytes(docs).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    slim = stable(slim.withColumn("text", F.col("text_crc32").cast("string")))
    return interleave(slim, shards, seed).select(
        "doc_id",
        "source",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int, seed: str = "shard") -> None:
    """Write the shards below ``path``, a folder each; a shard is one range of slots, sorted, in one or more files."""
    rows = interleave(docs, shards, seed)
    shard, slot, position = rows.columns[-3:]
    rows.repartitionByRange(position).sortWithinPartitions(shard, slot).drop(position).write.partitionBy(shard).parquet(path)
