"""How often each value occurs, and what follows from that: distinct values, moments, exact quantiles.

The map from values to counts is built by one pass over the rows, in which equal values collapse in the map tasks.
Everything else reads the map. Ranks come from a range partitioning of the map and the totals of its stretches, so
no task sorts a column; a hot value is one row of the map.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallymart.session import stable


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (column, value, n) of numeric columns, stored; NULL is no value, NaN is one."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    found = df.select(F.inline(cells)).where(F.col("value").isNotNull())
    return stable(found.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))


def moments_of_counts(counts: DataFrame) -> DataFrame:
    """Per column: count, distinct, min, max, mean and sample deviation. Squares are taken around the mean."""
    value, n = F.col("value"), F.col("n")
    first = counts.groupBy("column").agg(
        F.sum(n).alias("count"),
        F.count(F.lit(1)).alias("distinct"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        (F.sum(value * n) / F.sum(n)).alias("mean"),
    )
    away = value - F.col("mean")
    squares = counts.join(first.select("column", "mean"), "column").groupBy("column").agg(F.sum(n * away * away).alias("_squares"))
    deviation = F.sqrt(F.try_divide(F.col("_squares"), F.col("count") - 1))
    return first.join(squares, "column").withColumn("stddev", deviation).drop("_squares")


def quantiles_of_counts(counts: DataFrame, wanted: dict[str, list[float]]) -> DataFrame:
    """Exact quantiles with linear interpolation: rows (column, probability, value). NaN is skipped.

    Each wanted rank lies in one stretch of the range partitioning, and only such stretches are sorted.
    """
    spark = counts.sparkSession
    numbers = counts.where(F.col("column").isin(list(wanted)) & ~F.isnan("value"))
    spread = stable(numbers.repartitionByRange("column", "value").withColumn("stretch", F.spark_partition_id()))
    spans = spread.groupBy("column", "stretch").agg(F.sum("n").alias("held"))
    part = W.partitionBy("column")
    spans = spans.withColumns({"end": F.sum("held").over(part.orderBy("stretch")), "size": F.sum("held").over(part)})
    asked = spark.createDataFrame([(c, float(p)) for c, shares in wanted.items() for p in dict.fromkeys(shares)], "column string, probability double")
    position = F.col("probability") * (F.col("size") - 1)
    ends = F.array(*[F.struct(F.lit(k).alias("upper"), f(position).cast("bigint").alias("rank")) for k, f in ((0, F.floor), (1, F.ceil))])
    targets = spans.join(asked, "column").select("column", "stretch", "probability", "end", "held", "size", F.inline(ends))
    targets = targets.where((F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("held")))
    inside = spread.join(targets.select("column", "stretch", (F.col("end") - F.col("held")).alias("before")).distinct(), ["column", "stretch"])
    upto = F.col("before") + F.sum("n").over(W.partitionBy("column", "stretch").orderBy("value"))
    ranked = inside.withColumn("upto", upto)
    met = ranked.select("column", "stretch", "value", "n", "upto").join(targets.select("column", "stretch", "probability", "upper", "rank", "size"), ["column", "stretch"])
    met = met.where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
    found = met.groupBy("column", "probability").agg(
        F.max(F.when(F.col("upper") == 0, F.col("value"))).alias("low"),
        F.max(F.when(F.col("upper") == 1, F.col("value"))).alias("high"),
        F.max("size").alias("size"),
    )
    share = position - F.floor(position)
    return found.select("column", "probability", (F.col("low") + (F.col("high") - F.col("low")) * share).alias("value"))
