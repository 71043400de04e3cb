"""Churn features per customer and the reports on them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallymart.functions.defaults import CHURN_AFTER_DAYS
from tallymart.functions.money import money_avg, money_sum, ratio
from tallymart.functions.rules import all_present, as_of_day, flag

Day = dt.date | str | Column | None

ML_REQUIRED = ["avg_tx_amount", "total_tx_count", "days_since_last_tx", "customer_lifetime_days"]


def churn_features(
    transactions: DataFrame,
    customers: DataFrame,
    as_of: Day = None,
    churn_after_days: int = CHURN_AFTER_DAYS,
    processed_at: dt.datetime | None = None,
) -> DataFrame:
    """One row per customer with transactions; profile columns are NULL when the profile is missing.

    Recency counts from ``as_of``, by default the last day in the data. A customer is churned after
    more than ``churn_after_days`` days without a transaction. Transactions are aggregated before
    the join, so each customer joins as one row.
    """
    end = as_of_day(as_of, transactions, "tx_date")
    per_customer = transactions.groupBy("customer_id").agg(
        F.max("tx_date").alias("last_tx_date"),
        F.min("tx_date").alias("first_tx_date"),
        money_avg("tx_amount").alias("avg_tx_amount"),
        F.stddev_samp("tx_amount").alias("std_tx_amount"),
        F.count(F.lit(1)).alias("total_tx_count"),
        money_sum("tx_amount").alias("total_tx_amount"),
    )
    features = (
        per_customer.withColumn("days_since_last_tx", F.datediff(end, "last_tx_date"))
        .withColumn("customer_lifetime_days", F.datediff("last_tx_date", "first_tx_date"))
        .withColumn("is_churned", flag(F.col("days_since_last_tx") > churn_after_days))
        .withColumn("tx_frequency", F.col("total_tx_count") / F.greatest("customer_lifetime_days", F.lit(1)))
        .join(customers.select("customer_id", "registration_date", "region"), "customer_id", "left")
    )
    if processed_at is not None:
        features = features.withColumns(
            {
                "processing_date": F.lit(processed_at.date()),
                "processing_timestamp": F.lit(processed_at),
            }
        )
    return features.withColumn("analysis_reference_date", end)


def activity_churn(activity: DataFrame, end: Day = None, churn_after_days: int = CHURN_AFTER_DAYS) -> DataFrame:
    """Flag customers whose last transaction lies before ``end - churn_after_days``."""
    border = F.date_sub(as_of_day(end, activity, "last_tx_date"), churn_after_days)
    return activity.withColumn("is_churned", flag(F.col("last_tx_date") < border))


def activity_churn_summary(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy("is_churned").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.avg("tx_count").alias("avg_transactions"),
        F.avg("avg_tx_amount").alias("avg_amount"),
    )


def regional_churn(features: DataFrame) -> DataFrame:
    """Churn per region; customers without a profile form the NULL region."""
    return features.groupBy("region").agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.avg("avg_tx_amount").alias("avg_region_tx_amount"),
        F.avg("days_since_last_tx").alias("avg_days_since_last_tx"),
        F.sum("is_churned").alias("churned_customers"),
        (F.sum("is_churned") / F.count(F.lit(1)) * 100).alias("churn_rate_percent"),
    )


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows per class and their share of all rows in percent. The window sees one row per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("percentage", ratio(F.col("count"), F.sum("count").over(W.partitionBy())) * 100)


def region_churn_counts(features: DataFrame) -> DataFrame:
    return (
        features.groupBy("region", "is_churned").agg(F.count(F.lit(1)).alias("count")).orderBy("region", "is_churned")
    )


def churn_totals(features: DataFrame) -> DataFrame:
    """Churned customers, all customers and the rate (0.0 for an empty table)."""
    return features.agg(
        F.coalesce(F.sum("is_churned"), F.lit(0)).cast("bigint").alias("churned_customers"),
        F.count(F.lit(1)).alias("total_customers"),
        F.coalesce(ratio(F.sum("is_churned"), F.count(F.lit(1))), F.lit(0.0)).alias("churn_rate"),
    )


def model_rows(features: DataFrame) -> DataFrame:
    """The rows a model can use: the four base measures are present."""
    return features.where(all_present(ML_REQUIRED))


def feature_sample(features: DataFrame, limit: int) -> DataFrame:
    """Six columns of the first ``limit`` customers in key order."""
    # The columns of the sample.
    columns = ["customer_id", "is_churned", "avg_tx_amount", "total_tx_count", "days_since_last_tx", "region"]
    return features.select(*columns).orderBy("customer_id").limit(limit)
