"""Profiles of raw tables: gaps, repeats, outliers, spike days, patterns, correlations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tallymart.functions.money import money, money_sum, percent, ratio
from tallymart.operators import sketches
from tallymart.operators.counts import moments_of_counts, quantiles_of_counts, value_counts


def describe_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum per column as rows (column, stat, value)."""
    stats = {"count": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    row = df.agg(*[fn(c).cast("double").alias(f"{c}.{name}") for c in columns for name, fn in stats.items()])
    cells = [
        F.struct(F.lit(c).alias("column"), F.lit(name).alias("stat"), F.col(f"`{c}.{name}`").alias("value"))
        for c in columns
        for name in stats
    ]
    return row.select(F.inline(F.array(*cells)))


def null_and_negative(df: DataFrame, amount: str = "amount") -> DataFrame:
    """Rows, missing and negative amounts, and their shares in percent."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(amount).isNull()).alias("null_amounts"),
        F.count_if(F.col(amount) < 0).alias("negative_amounts"),
    )
    return counts.withColumns(
        {
            "null_percentage": percent(F.col("null_amounts"), F.col("total_rows")),
            "negative_percentage": percent(F.col("negative_amounts"), F.col("total_rows")),
        }
    )


def missing_values(df: DataFrame) -> DataFrame:
    """Per column: rows, missing values and their share. Blank text counts as missing."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}

    def missing(column: str):
        gap = F.col(column).isNull()
        return gap | (F.trim(F.col(column)) == "") if column in texts else gap

    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(missing(c)).alias(c) for c in df.columns])
    cells = [
        F.struct(F.lit(c).alias("column"), F.col("_rows").alias("rows"), F.col(c).alias("missing")) for c in df.columns
    ]
    return counts.select(F.inline(F.array(*cells))).withColumn(
        "missing_percent", percent(F.col("missing"), F.col("rows"))
    )


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with the number of copies."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def outlier_fence(df: DataFrame, column: str, width: float = 1.5, exact: bool = True) -> DataFrame:
    """One row: the quartiles and the fence ``width`` interquartile ranges beyond them.

    Exact quartiles come from the counts of values; ``exact=False`` takes them from sketches, in one pass without
    a shuffle of values.
    """
    if exact:
        found = quantiles_of_counts(value_counts(df, [column]), {column: [0.25, 0.75]})
        quartiles = found.agg(*[F.max(F.when(F.col("probability") == p, F.col("value"))).alias(n) for n, p in (("q1", 0.25), ("q3", 0.75))])
    else:
        quartiles = sketches.quantile_row(df, {"q1": (column, 0.25), "q3": (column, 0.75)})
    reach = (F.col("q3") - F.col("q1")) * width
    return quartiles.withColumns({"low_fence": F.col("q1") - reach, "high_fence": F.col("q3") + reach})


def outliers(df: DataFrame, column: str, width: float = 1.5, exact: bool = True) -> DataFrame:
    """Rows whose value lies outside the fence."""
    fence = outlier_fence(df, column, width, exact).select(F.struct("low_fence", "high_fence")).scalar()
    return df.where((F.col(column) < fence["low_fence"]) | (F.col(column) > fence["high_fence"]))


def daily_series(df: DataFrame, date: str, amount: str) -> DataFrame:
    return df.groupBy(F.col(date).alias("day")).agg(
        F.count(F.lit(1)).alias("orders"), money_sum(amount).alias("revenue")
    )


def spike_days(df: DataFrame, date: str, threshold: float = 6.0) -> DataFrame:
    """Days whose row count lies more than ``threshold`` scaled median deviations above the median day.

    The medians run over one row per day, so their size is bounded by the calendar.
    """
    days = df.groupBy(F.col(date).alias("day")).agg(F.count(F.lit(1)).alias("rows"))
    typical = days.agg(F.median("rows")).scalar()
    deviations = days.withColumn("median_rows", typical).withColumn(
        "_away", F.abs(F.col("rows") - F.col("median_rows"))
    )
    spread = deviations.agg(F.median("_away")).scalar()
    # Fixed value: scales a median absolute deviation to a standard deviation of normal data.
    limit = F.col("median_rows") + F.col("mad") * 1.4826 * threshold
    return deviations.drop("_away").withColumn("mad", spread).withColumn("limit", limit).where("rows > limit")


def hourly_pattern(df: DataFrame, time: str, amount: str) -> DataFrame:
    return df.groupBy(F.hour(time).alias("hour")).agg(
        F.count(F.lit(1)).alias("orders"), money_sum(amount).alias("revenue")
    )


def weekday_pattern(df: DataFrame, time: str, amount: str) -> DataFrame:
    """Orders and revenue per day of the week, Monday is 0."""
    return df.groupBy(F.weekday(time).alias("weekday")).agg(
        F.count(F.lit(1)).alias("orders"), money_sum(amount).alias("revenue")
    )


def breakdowns(df: DataFrame, dimensions: list[str], amount: str = "amount") -> DataFrame:
    """Orders, revenue and mean amount per value of each dimension, from one scan.

    Rows are totalled per combination of values first; each combination, not each row, then counts
    for every dimension.
    """
    totals = df.groupBy(*dimensions).agg(
        F.count(F.lit(1)).alias("_orders"), F.count(amount).alias("_amounts"), F.sum(money(amount)).alias("_revenue")
    )
    cells = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("item")) for d in dimensions])
    return (
        totals.select("_orders", "_amounts", "_revenue", F.inline(cells))
        .groupBy("dimension", "item")
        .agg(
            F.sum("_orders").alias("orders"),
            F.sum("_revenue").cast("double").alias("revenue"),
            ratio(F.sum("_revenue"), F.sum("_amounts")).alias("avg_amount"),
        )
    )


def new_and_returning(df: DataFrame, date: str, amount: str = "amount") -> DataFrame:
    """Per month: orders and revenue of customers on their first day and on later days.

    Rows are totalled per customer and day first, so the window of a customer is bounded by the calendar.
    """
    per_day = df.groupBy("customer_id", F.col(date).alias("_day")).agg(
        F.count(F.lit(1)).alias("_orders"), F.sum(money(amount)).alias("_revenue")
    )
    first = F.min("_day").over(W.partitionBy("customer_id"))
    kind = F.when(F.col("_day") == F.col("_first"), "new").otherwise("returning")
    return (
        per_day.withColumn("_first", first)
        .groupBy(F.trunc("_day", "month").alias("month"), kind.alias("customer_kind"))
        .agg(F.sum("_orders").alias("orders"), F.sum("_revenue").cast("double").alias("revenue"))
    )


def flag_rates(df: DataFrame, by: str, flags: list[str]) -> DataFrame:
    """Share of rows with each 0/1 flag set, per group."""
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("orders"), *[ratio(F.sum(f), F.count(f)).alias(f"{f}_rate") for f in flags]
    )


_QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def _quartiles(found: DataFrame) -> DataFrame:
    return found.groupBy("column").agg(*[F.max(F.when(F.col("probability") == p, F.col("value"))).alias(n) for n, p in _QUARTILES.items()])


def column_profile(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """Per numeric column: count, distinct values, minimum, maximum, mean, deviation and quartiles.

    Exact: one pass over the rows makes a map from values to counts, from which everything follows; the map is as
    large as the columns have values. ``exact=False`` keeps a sketch per column instead: one pass, nothing shuffled
    but sketches, distinct values within 5 percent and quartiles within the sketches' rank error.
    """
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    if exact:
        counts = value_counts(df, columns)
        found = moments_of_counts(counts).join(_quartiles(quantiles_of_counts(counts, {c: list(_QUARTILES.values()) for c in columns})), "column", "left")
    else:
        stats = {"count": F.count, "distinct": F.approx_count_distinct, "min": F.min, "max": F.max, "mean": F.avg, "stddev": F.stddev_samp}
        cells = [fn(F.col(c).cast("double")).alias(f"_{s}{k}") for k, c in enumerate(columns) for s, fn in stats.items()]
        row = df.agg(*cells, *[sketches.sketch(c).alias(f"_sketch{k}") for k, c in enumerate(columns)])
        listed = [
            F.struct(
                F.lit(c).alias("column"),
                *[F.col(f"_{s}{k}").alias(s) for s in stats],
                *[F.when(F.col(f"_count{k}") > 0, F.kll_sketch_get_quantile_double(f"_sketch{k}", F.lit(p))).alias(n) for n, p in _QUARTILES.items()],
            )
            for k, c in enumerate(columns)
        ]
        found = row.select(F.inline(F.array(*listed)))
    found = names.join(found, "column", "left")
    return found.select(
        "column",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("count", "distinct")],
        *["min", "max", "mean", "stddev", *_QUARTILES],
    )


def geo_grid(df: DataFrame, step: float = 10.0) -> DataFrame:
    """Orders and customers per cell of a latitude/longitude grid."""
    return df.groupBy(
        F.floor(F.col("lat") / step).cast("int").alias("lat_cell"),
        F.floor(F.col("lon") / step).cast("int").alias("lon_cell"),
    ).agg(F.count(F.lit(1)).alias("orders"), F.count_distinct("customer_id").alias("customers"))
