"""Synthetic minority rows on the segments between near neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.defaults import NEIGHBOURS, SEED
from tallymart.functions.hashing import key_hash, unit_interval
from tallymart.operators.neighbours import nearest_neighbours
from tallymart.operators.ranks import hash_cutoffs, row_numbers
from tallymart.session import stable

CHUNK = 10_000


def synthetic_rows(
    minority: DataFrame, features: list[str], key: str, size: int, needed: int, k: int = NEIGHBOURS, seed: int = SEED
) -> DataFrame:
    """``needed`` rows ``x + u * (neighbour - x)`` over the ``size`` minority rows x.

    Every row gives the same number of synthetic rows; the remainder goes to the rows with the
    smallest key hash, of rows that share a key to the smallest points. Equal rows are worked on as one point with a count, and a point with many
    synthetic rows hands them out in chunks, so no copy group is made in one task.
    """
    each, rest = divmod(needed, size)
    spark = minority.sparkSession
    point = F.array(*[F.col(f).cast("double") for f in features])
    rows = stable(minority.select(F.lit(0).alias("_all"), key_hash(key, seed).alias("_hash"), point.alias("point")))
    quota = spark.createDataFrame([(0, "rest", rest)], "_all int, part string, quota bigint")
    border = hash_cutoffs(rows, "_all", "_hash", quota).first()
    rows = rows.withColumn("_extra", F.lit(0) if border is None else (F.col("_hash") <= border["cutoff"]).cast("int"))
    if border is not None and border["allowed"] < border["copies"]:
        at = F.col("_hash") == border["cutoff"]
        tied = row_numbers(rows.where(at).drop("_extra"), ["_all"], ["point"], "_copy")
        tied = tied.withColumn("_extra", (F.col("_copy") <= border["allowed"]).cast("int")).drop("_copy")
        rows = rows.where(~at).unionByName(tied)
    points = stable(
        rows.groupBy("point").agg(
            F.count(F.lit(1)).alias("weight"), (F.count(F.lit(1)) * each + F.sum("_extra")).alias("wanted")
        )
    )
    near = nearest_neighbours(points, len(features), k, seed).where("wanted > 0")
    chunks = near.select(
        "point",
        "neighbours",
        "wanted",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("wanted") - 1, F.lit(CHUNK).cast("bigint"))).alias("_from"),
    ).repartition("point", "_from")
    numbered = chunks.select(
        "point",
        "neighbours",
        F.explode(F.sequence("_from", F.least(F.col("_from") + CHUNK, "wanted") - 1)).alias("_number"),
    )
    choice = F.floor(unit_interval("point", "_number", F.lit(f"{seed}|n")) * F.size("neighbours")).cast("int") + 1
    drawn = numbered.select(
        "point",
        F.element_at("neighbours", choice).alias("_near"),
        unit_interval("point", "_number", F.lit(f"{seed}|u")).alias("_u"),
    )
    return drawn.select(
        *[
            (F.col("point")[i] + F.col("_u") * (F.col("_near")[i] - F.col("point")[i])).alias(f)
            for i, f in enumerate(features)
        ]
    )


def oversample_minority(
    df: DataFrame, features: list[str], label: str, key: str, k: int = NEIGHBOURS, seed: int = SEED, most_classes: int = 100
) -> DataFrame:
    """Raise every class to the size of the largest with synthetic rows: rows (features, label, is_synthetic).

    Keys may repeat; labels must be present. More than ``most_classes`` label values are refused, since the work
    is done class by class. The input comes back with its features as doubles. A class of no more than ``k`` rows
    has too few neighbours and stays as it is; the others are raised.
    """
    original = df.select(*[F.col(f).cast("double").alias(f) for f in features], label, F.lit(0).alias("is_synthetic"))
    sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).limit(most_classes + 1).collect()}
    if None in sizes:
        raise ValueError(f"{sizes[None]} rows have no {label}; drop them or label them")
    if len(sizes) > most_classes:
        raise ValueError(f"{label} has more than {most_classes} values")
    if len(sizes) < 2:
        return original
    largest = max(sizes.values())
    small = {c: n for c, n in sizes.items() if n < largest}
    result = original
    for value, size in sorted(small.items(), key=lambda item: str(item[0])):
        if size <= k:
            continue
        made = synthetic_rows(df.where(F.col(label) == value), features, key, size, largest - size, k, seed)
        result = result.unionByName(
            made.withColumns({label: F.lit(value).cast(df.schema[label].dataType), "is_synthetic": F.lit(1)})
        )
    return result
