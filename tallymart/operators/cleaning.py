"""Rule-based cleaning of transactions and customers, and the data-quality report."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.functions.defaults import MAX_AMOUNT, PROFILE_MAX_AGE_DAYS, TOP_DAYS, TRANSACTION_MAX_AGE_DAYS
from tallymart.functions.money import money_avg, percent
from tallymart.functions.rules import all_present, day, non_blank, within_days_before

Day = dt.date | str | Column

TRANSACTION_KEYS = ["customer_id", "tx_date", "tx_amount"]
CUSTOMER_KEYS = ["customer_id"]


def transaction_rules(
    as_of: Column, max_amount: float = MAX_AMOUNT, max_age_days: int = TRANSACTION_MAX_AGE_DAYS
) -> dict[str, Column]:
    """What a transaction must satisfy, in the order in which the rules are applied."""
    return {
        "missing_value": all_present(TRANSACTION_KEYS),
        "blank_customer": non_blank("customer_id"),
        "amount_not_positive": F.col("tx_amount") > 0,
        "amount_over_cap": F.col("tx_amount") <= max_amount,
        "date_out_of_window": within_days_before("tx_date", as_of, max_age_days),
    }


def customer_rules(as_of: Column, max_age_days: int = PROFILE_MAX_AGE_DAYS) -> dict[str, Column]:
    """What a customer profile must satisfy."""
    return {
        "missing_value": all_present(["customer_id", "registration_date", "region"]),
        "blank_customer": non_blank("customer_id"),
        "blank_region": non_blank("region"),
        "date_out_of_window": within_days_before("registration_date", as_of, max_age_days),
    }


def keep_valid(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, rules.values()))


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the smallest in ``order`` (NULL first).

    Written as an aggregate, not a window: copies collapse in the map tasks, so one key with a third
    of all rows reaches its reducer as one row per task.
    """
    others = [c for c in df.columns if c not in keys and c not in order]
    smallest = F.min(F.struct(*order, *others)).alias("_kept")
    return df.groupBy(*keys).agg(smallest).select(*keys, "_kept.*").select(*df.columns)


def clean_transactions(
    transactions: DataFrame, as_of: Day, max_amount: float = MAX_AMOUNT, max_age_days: int = TRANSACTION_MAX_AGE_DAYS
) -> DataFrame:
    """Valid transactions, one per (customer, day, amount): the one with the smallest id.

    The day is the caller's: raw rows may hold dates of the future, so none of theirs can stand for today.
    """
    rules = transaction_rules(day(as_of), max_amount, max_age_days)
    return first_per_key(keep_valid(transactions, rules), TRANSACTION_KEYS, ["transaction_id"])


def clean_customers(customers: DataFrame, as_of: Day, max_age_days: int = PROFILE_MAX_AGE_DAYS) -> DataFrame:
    """Valid profiles, one per customer: the earliest registration."""
    rules = customer_rules(day(as_of), max_age_days)
    return first_per_key(keep_valid(customers, rules), CUSTOMER_KEYS, ["registration_date", "region"])


def cleaning_statistics(df: DataFrame, rules: dict[str, Column], keys: list[str]) -> DataFrame:
    """Rows before and after cleaning, and the rows each rule removes, in one pass and one row.

    A row counts for the first rule it breaks. Invalid rows are grouped by that rule alone, so
    they collapse in the map tasks.
    """
    broken = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()])
    verdicts = df.select(broken.alias("_broken"), *keys).select(
        "_broken", *[F.when(F.col("_broken").isNull(), F.col(k)).alias(k) for k in keys]
    )
    groups = verdicts.groupBy("_broken", *keys).agg(F.count(F.lit(1)).alias("_rows"))
    valid = F.col("_broken").isNull()

    def rows_where(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("_rows")).otherwise(0))

    counts = groups.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("original_count"),
        *[F.coalesce(rows_where(F.col("_broken") == name), F.lit(0)).alias(f"removed_{name}") for name in rules],
        F.coalesce(rows_where(valid) - F.count_if(valid), F.lit(0)).alias("removed_duplicate"),
        F.count_if(valid).alias("cleaned_count"),
    )
    removed = F.col("original_count") - F.col("cleaned_count")
    return counts.withColumn("removed_count", removed).withColumn(
        "removed_percent", percent(F.col("removed_count"), F.col("original_count"))
    )


#: Columns that the written table has besides those of the rows: the rule that removed a row, and how many it stands for.
RULE, COPIES, KEPT = "cleaning_rule", "cleaning_copies", "kept"


def clean_and_count(
    df: DataFrame, rules: dict[str, Column], keys: list[str], order: list[str], path: str, profile: dict[str, Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Write the cleaned rows below ``path``; they are returned with their statistics, from one scan of ``df``.

    What is written is partitioned by rule: cleaned rows, each with the number of copies it stands for, and one row per
    rule with the number of rows it removed, collapsed in the map tasks. So the statistics, those of
    ``cleaning_statistics``, are sums over one narrow column of the written table, exact also if tasks ran twice. The
    aggregates ``profile`` are taken of the cleaned rows.
    """
    spark = df.sparkSession
    broken = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()], F.lit(KEPT))
    marked, kept = df.withColumn(RULE, broken), F.col(RULE) == KEPT
    others = [c for c in df.columns if c not in keys and c not in order]
    smallest = F.min(F.when(kept, F.struct(*order, *others, F.lit(0).alias("_one")))).alias("_kept")
    grouped = marked.groupBy(RULE, *[F.when(kept, F.col(k)).alias(k) for k in keys]).agg(smallest, F.count(F.lit(1)).alias(COPIES))
    rows = grouped.select(*[F.col(c) if c in keys else F.col(f"_kept.`{c}`").alias(c) for c in df.columns], COPIES, RULE)
    rows.write.mode("overwrite").partitionBy(RULE).parquet(path)
    extra = [T.StructField(COPIES, T.LongType()), T.StructField(RULE, T.StringType())]
    back = spark.read.schema(T.StructType([*df.schema.fields, *extra])).parquet(path)
    cleaned = back.where(kept).select(*df.columns)

    def total(condition: Column, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0)).cast("bigint")

    counts = back.agg(
        total(F.lit(True), F.col(COPIES)).alias("original_count"),
        *[total(F.col(RULE) == name, F.col(COPIES)).alias(f"removed_{name}") for name in rules],
        total(kept, F.col(COPIES) - 1).alias("removed_duplicate"),
        F.count_if(kept).alias("cleaned_count"),
    )
    removed = F.col("original_count") - F.col("cleaned_count")
    counts = counts.withColumn("removed_count", removed).withColumn("removed_percent", percent(F.col("removed_count"), F.col("original_count")))
    return cleaned, counts.withColumns({n: cleaned.agg(v).scalar() for n, v in profile.items()}) if profile else counts


def amount_aggregates() -> dict[str, Column]:
    return {
        "avg_amount": money_avg("tx_amount"),
        "std_amount": F.stddev_samp("tx_amount"),
        "min_amount": F.min("tx_amount"),
        "max_amount": F.max("tx_amount"),
    }


def amount_profile(transactions: DataFrame) -> DataFrame:
    return transactions.agg(*[value.alias(name) for name, value in amount_aggregates().items()])


def frequency(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Rows per value, most frequent first, ties in value order; optionally the top ``limit``."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), column)
    return counts if limit is None else counts.limit(limit)


def key_coverage(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers on one side only, counted without a join: one row per key after partial aggregation."""
    marks = transactions.select("customer_id", F.lit(1).alias("_tx"), F.lit(0).alias("_profile")).unionByName(
        customers.select("customer_id", F.lit(0).alias("_tx"), F.lit(1).alias("_profile"))
    )
    sides = marks.groupBy("customer_id").agg(F.max("_tx").alias("_tx"), F.max("_profile").alias("_profile"))
    return sides.agg(
        F.count_if(F.col("_tx") == 0).alias("customers_without_transactions"),
        F.count_if(F.col("_profile") == 0).alias("transactions_without_profile"),
    )


def _has_rows(df: DataFrame) -> Column:
    return df.select(F.lit(1).alias("_one")).limit(1).agg(F.count("_one") > 0).scalar()


def quality_report(transactions: DataFrame, customers: DataFrame, top_days: int = TOP_DAYS) -> DataFrame:
    """Rows (check, item, value): key mismatches, date span and busiest days; empty if a side is empty."""

    def lines(df: DataFrame, names: list[str]) -> DataFrame:
        cells = [
            F.struct(F.lit(n).alias("check"), F.lit("").alias("item"), F.col(n).cast("string").alias("value"))
            for n in names
        ]
        return df.select(F.inline(F.array(*cells)))

    days = transactions.groupBy("tx_date").agg(F.count(F.lit(1)).alias("count"))
    span = days.agg(F.min("tx_date").alias("first_tx_date"), F.max("tx_date").alias("last_tx_date"))
    busiest = days.orderBy(F.desc("count"), "tx_date").limit(top_days)
    report = (
        lines(
            key_coverage(transactions, customers), ["customers_without_transactions", "transactions_without_profile"]
        )
        .unionByName(lines(span, ["first_tx_date", "last_tx_date"]))
        .unionByName(
            busiest.select(
                F.lit("busiest_day").alias("check"),
                F.col("tx_date").cast("string").alias("item"),
                F.col("count").cast("string").alias("value"),
            )
        )
    )
    return report.where(_has_rows(transactions) & _has_rows(customers))
