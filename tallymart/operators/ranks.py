"""Ranks, running totals and quantiles over whole tables without a single-task sort.

Running totals: the value range is cut into as many buckets as a shuffle has partitions. Bucket
totals are a small table; their running total gives every bucket its start, and only rows of one
bucket meet in one task.

Quantiles: approximate quantiles bracket the wanted rank, plain counts give the exact rank of the
bracket, and only values inside it are sorted.

Cut points and brackets are literals in the plan, so a recomputed task repeats them.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, floor, inf, isnan

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallymart.session import stable

HASH_DIGITS = 4


def bucket_count(df: DataFrame) -> int:
    """One bucket per shuffle partition of the session, at least 8 and at most 4096."""
    return min(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8), 4096)


def cut_points(df: DataFrame, columns: list[str], buckets: int) -> dict[str, list[float]]:
    """Approximate quantiles of each column, one pass for all. At most ``buckets - 1`` numbers each."""
    shares = [i / buckets for i in range(1, buckets)]
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, 10 * buckets).alias(c) for c in columns]).first()
    return {c: sorted({v for v in row[c] or [] if not isnan(v)}) for c in columns}


def with_bucket(df: DataFrame, column: str, points: list[float], name: str) -> DataFrame:
    """Add the number of the bucket of ``column``; larger values never get a smaller number, NULL gets -1."""
    inner = [p for p in points if -inf < p < inf]
    if not inner:
        return df.withColumn(name, F.when(F.col(column).isNull(), -1.0).otherwise(0.0))
    cutter = Bucketizer(splits=[-inf, *inner, inf], inputCol=column, outputCol=name, handleInvalid="keep")
    return cutter.transform(df).withColumn(name, F.coalesce(name, F.lit(-1.0)))


def running_totals(
    df: DataFrame, value: str, measures: list[str], descending: bool = False, buckets: int | None = None
) -> DataFrame:
    """Add ``cum_<measure>``: the running sum in the order of ``value``, whose values are distinct.

    The rows are read for the cut points, the bucket totals and the sums: hand in stored rows.
    """
    points = cut_points(df, [value], buckets or bucket_count(df))[value]
    tagged = with_bucket(df, value, points, "_bucket")

    def ordered(column: str) -> Column:
        return F.desc(column) if descending else F.asc(column)

    totals = tagged.groupBy("_bucket").agg(*[F.sum(m).alias(m) for m in measures])
    before = W.orderBy(ordered("_bucket")).rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select(
        "_bucket", *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"_start_{m}") for m in measures]
    )
    inside = W.partitionBy("_bucket").orderBy(ordered(value)).rowsBetween(W.unboundedPreceding, W.currentRow)
    return tagged.join(F.broadcast(starts), "_bucket").select(
        *df.columns, *[(F.sum(m).over(inside) + F.col(f"_start_{m}")).alias(f"cum_{m}") for m in measures]
    )


class _Bracket:
    """A value range that holds the wanted rank of a column, with the exact rows below and inside it."""

    def __init__(self, column: str, probability: float):
        self.column = column
        self.probability = probability
        self.low, self.high = -inf, inf
        self.below = self.inside = self.size = 0

    @property
    def position(self) -> float:
        return self.probability * (self.size - 1)

    @property
    def range(self) -> tuple[str, float, float]:
        return self.column, self.low, self.high

    def holds(self) -> Column:
        return F.col(self.column).between(F.lit(self.low), F.lit(self.high))

    def narrow(self, low: float, high: float, below: int, upto: int) -> bool:
        """Take over each end that provably keeps the rank inside; tell whether the bracket shrank."""
        end, before = self.below + self.inside, self.inside
        if below <= floor(self.position):
            self.low, self.below = low, below
        if upto > ceil(self.position):
            self.high, end = high, upto
        self.inside = end - self.below
        return self.inside < before


def _narrow_all(df: DataFrame, brackets: list[_Bracket], accuracy: int, limit: int) -> None:
    """Narrow the brackets until each has at most ``limit`` rows or holds a single hot value.

    One round is two aggregations over the columns: approximate quantiles on both sides of the rank,
    then exact counts at those values. Nothing is shuffled but the partial results.
    """
    margin = 2.0 / accuracy
    columns = sorted({b.column for b in brackets})
    todo = brackets
    first = True
    while todo:
        groups: dict[tuple[str, float, float], list[_Bracket]] = {}
        for b in todo:
            groups.setdefault(b.range, []).append(b)
        aggregates = []
        for g, members in enumerate(groups.values()):
            ends = []
            for b in members:
                share = b.probability if first else (b.position - b.below) / max(b.inside - 1, 1)
                ends += [min(max(share - margin, 0.0), 1.0), min(max(share + margin, 0.0), 1.0)]
            values = F.when(members[0].holds(), F.col(members[0].column))
            aggregates.append(F.percentile_approx(values, ends, accuracy).alias(f"_{g}"))
        sizes = [F.count(c).alias(c) for c in columns] if first else []
        row = df.agg(*aggregates, *sizes).first()
        if first:
            for b in brackets:
                b.size = b.inside = row[b.column]
        found = [
            (b, row[f"_{g}"][2 * i], row[f"_{g}"][2 * i + 1])
            for g, members in enumerate(groups.values())
            if row[f"_{g}"]
            for i, b in enumerate(members)
        ]
        if not found:
            return
        counts = df.agg(
            *[F.count_if(F.col(b.column) < low).alias(f"below{i}") for i, (b, low, _) in enumerate(found)],
            *[F.count_if(F.col(b.column) <= high).alias(f"upto{i}") for i, (b, _, high) in enumerate(found)],
        ).first()
        shrunk = [
            b
            for i, (b, low, high) in enumerate(found)
            if b.narrow(low, high, counts[f"below{i}"], counts[f"upto{i}"])
        ]
        todo = [b for b in shrunk if b.inside > limit and b.low < b.high]
        first = False


def exact_quantiles(
    df: DataFrame, wanted: dict[str, list[float]], accuracy: int = 10_000, limit: int = 5_000_000
) -> DataFrame:
    """Exact quantiles with linear interpolation: rows (column, probability, value).

    NULL and NaN are skipped. Two or more narrow scans bracket the wanted ranks; the last one reads,
    counts and sorts only the values inside the brackets, which are plain range predicates that the
    scan can use. Hand in stored rows when the input is costly to compute.
    """
    brackets = [_Bracket(c, float(p)) for c, shares in wanted.items() for p in shares]
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in wanted])
    _narrow_all(numbers.select(*[F.nanvl(c, F.lit(None)).alias(c) for c in wanted]), brackets, accuracy, limit)

    def literal(values: list) -> Column:
        return F.array(*[F.lit(v) for v in values])[F.col("target")]

    cells = F.array(
        *[
            F.struct(F.lit(i).alias("target"), F.when(b.holds(), F.col(b.column)).alias("value"))
            for i, b in enumerate(brackets)
        ]
    )
    counts = (
        numbers.where(reduce(lambda x, y: x | y, [b.holds() for b in brackets]))
        .select(F.inline(cells))
        .where(F.col("value").isNotNull())
        .groupBy("target", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    running = F.sum("n").over(W.partitionBy("target").orderBy("value"))
    ranked = counts.withColumn("last", literal([b.below for b in brackets]) + running)

    def at_rank(ranks: list[int]) -> Column:
        rank = literal(ranks)
        return F.max(F.when((rank < F.col("last")) & (rank >= F.col("last") - F.col("n")), F.col("value")))

    positions = [b.position for b in brackets]
    lower, upper = F.col("lower"), F.col("upper")
    return (
        ranked.groupBy("target")
        .agg(
            at_rank([floor(p) for p in positions]).alias("lower"), at_rank([ceil(p) for p in positions]).alias("upper")
        )
        .select(
            literal([b.column for b in brackets]).alias("column"),
            literal([b.probability for b in brackets]).alias("probability"),
            (lower + (upper - lower) * literal([p - floor(p) for p in positions])).alias("value"),
        )
    )


def quantile_row(df: DataFrame, wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """Exact quantiles as one row: ``{name: (column, probability)}``."""
    shares: dict[str, list[float]] = {}
    for column, probability in wanted.values():
        if probability not in shares.setdefault(column, []):
            shares[column].append(probability)
    found = exact_quantiles(df, shares)
    return found.agg(
        *[
            F.max(F.when((F.col("column") == c) & (F.col("probability") == p), F.col("value"))).alias(name)
            for name, (c, p) in wanted.items()
        ]
    )


def hash_cutoffs(df: DataFrame, group: str, hashed: str, quotas: DataFrame) -> DataFrame:
    """The hash of the ``quota``-th row of each group in hash order: rows (group, part, cutoff, copies, allowed).

    ``quotas`` has (group, part, quota), a few rows per group. The first hash digits cut each group
    into equal buckets; only the bucket that holds the wanted rank is sorted, so a group with most of
    the rows costs one aggregation. Rows with the same hash are counted, not sorted one by one: ``copies`` rows
    have the cutoff's hash, and the quota has room for ``allowed`` of them. A quota of zero gives no row.
    """
    prefix = F.substring(F.col(hashed), 1, HASH_DIGITS)
    rows = df.select(F.col(group), F.col(hashed), prefix.alias("_prefix"))
    totals = rows.groupBy(group, "_prefix").agg(F.count(F.lit(1)).alias("_rows"))
    spans = totals.withColumn("_end", F.sum("_rows").over(W.partitionBy(group).orderBy("_prefix")))
    targets = (
        spans.join(quotas.where("quota > 0"), group)
        .where((F.col("quota") <= F.col("_end")) & (F.col("quota") > F.col("_end") - F.col("_rows")))
        .select(group, "_prefix", "part", (F.col("quota") - F.col("_end") + F.col("_rows")).alias("_nth"))
    )
    upto = F.sum("copies").over(W.partitionBy(group, "part").orderBy(hashed))
    return (
        rows.join(targets, [group, "_prefix"])
        .groupBy(group, "part", "_nth", hashed)
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("_upto", upto)
        .where(F.col("_nth").between(F.col("_upto") - F.col("copies") + 1, F.col("_upto")))
        .select(
            group, "part", F.col(hashed).alias("cutoff"), "copies", (F.col("_nth") - F.col("_upto") + F.col("copies")).alias("allowed")
        )
    )


def row_numbers(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Add the number of each row within its keys, from 1 on in the given order, without a sort of a key in one task.

    A range partitioning cuts the rows into stretches; the rows of a stretch are numbered after those of the
    stretches before it. The rows are stored first with a number of their own, by which equal ones are cut apart.
    Keys hold no NULL.
    """
    own = stable(df.withColumn("_own", F.monotonically_increasing_id()))
    cut = stable(own.repartitionByRange(*keys, *order, "_own").withColumn("_stretch", F.spark_partition_id()))
    sizes = cut.groupBy(*keys, "_stretch").agg(F.count(F.lit(1)).alias("_held"))
    before = F.sum("_held").over(W.partitionBy(*keys).orderBy("_stretch")) - F.col("_held")
    sizes = sizes.select(*keys, "_stretch", before.alias("_before"))
    inside = F.row_number().over(W.partitionBy(*keys, "_stretch").orderBy(*order, "_own"))
    numbered = cut.withColumn("_inside", inside).join(sizes, [*keys, "_stretch"])
    return numbered.select(*df.columns, (F.col("_inside") + F.col("_before")).alias(name))
