"""Customer base mart and the composite risk label."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions.defaults import RECENT_DAYS
from tallymart.functions.money import money_avg, money_sum
from tallymart.functions.rules import as_of_day, existing, flag
from tallymart.operators import sketches
from tallymart.operators.ranks import quantile_row
from tallymart.session import stable

Day = dt.date | str | Column | None

# The default feature lists of the risk model and of the segmentation.
RISK_FEATURES = [
    "total_spent",
    "days_since_last_transaction",
    "transactions_last_90d",
    "total_transactions",
    "avg_transaction_amount",
]
SEGMENT_FEATURES = ["total_transactions", "total_spent", "days_since_last_transaction", "transactions_last_90d"]
# The measures from which the label is computed.
LABEL_INPUTS = ["days_since_last_transaction", "total_spent", "transactions_last_90d"]


def customer_base(transactions: DataFrame, as_of: Day = None, recent_days: int = RECENT_DAYS) -> DataFrame:
    """One row per customer: totals, recency and the count within ``(as_of - recent_days, as_of]``."""
    end = as_of_day(as_of, transactions, "tx_date")
    recent = (F.col("tx_date") > F.date_sub(end, recent_days)) & (F.col("tx_date") <= end)
    return (
        transactions.groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("total_transactions"),
            money_sum("tx_amount").alias("total_spent"),
            money_avg("tx_amount").alias("avg_transaction_amount"),
            F.max("tx_date").alias("_last"),
            F.count_if(recent).alias("transactions_last_90d"),
        )
        .withColumn("days_since_last_transaction", F.datediff(end, "_last"))
        .drop("_last")
    )


def median_thresholds(base: DataFrame, exact: bool = True) -> DataFrame:
    """One row with the medians of recency, spending and recent activity; ``exact=False`` takes them from sketches."""
    wanted = {
        "days_median": ("days_since_last_transaction", 0.5),
        "spent_median": ("total_spent", 0.5),
        "activity_median": ("transactions_last_90d", 0.5),
    }
    return quantile_row(base, wanted) if exact else sketches.quantile_row(base, wanted)


def composite_risk(base: DataFrame, exact: bool = True) -> DataFrame:
    """Three 0/1 risks against the medians and ``composite_risk``: at least two of them.

    A missing measure gives risk 0. When the median of recent activity is 0, no customer lies below it.
    The base is stored once: the medians take passes of their own, which must not rescan transactions.
    """
    base = stable(base)
    row = median_thresholds(base, exact)
    medians = row.select(F.struct(*row.columns)).scalar()
    risks = base.withColumns(
        {
            "days_risk": flag(F.col("days_since_last_transaction") > medians["days_median"]),
            "spending_risk": flag(F.col("total_spent") < medians["spent_median"]),
            "activity_risk": flag(F.col("transactions_last_90d") < medians["activity_median"]),
        }
    )
    at_risk = F.col("days_risk") + F.col("spending_risk") + F.col("activity_risk")
    return risks.withColumn("composite_risk", flag(at_risk >= 2))


def feature_names(df: DataFrame, features: list[str] | None = None, exclude_leaky: bool = False) -> list[str]:
    """The features that exist, in order; ``exclude_leaky`` leaves out the inputs of the label."""
    names = existing(df, features or RISK_FEATURES)
    return [n for n in names if n not in LABEL_INPUTS] if exclude_leaky else names


def select_features(
    df: DataFrame,
    label: str = "composite_risk",
    features: list[str] | None = None,
    key: str = "customer_id",
    exclude_leaky: bool = False,
) -> DataFrame:
    """Key, existing features and label."""
    return df.select(key, *feature_names(df, features, exclude_leaky), label)


def risk_by_group(risks: DataFrame, places: DataFrame, group: str) -> DataFrame:
    """Customers, customers at risk and the share at risk per group, highest share first."""
    return (
        risks.select("customer_id", "composite_risk", "total_spent")
        .join(places.select("customer_id", group), "customer_id")
        .groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum("composite_risk").alias("at_risk"),
            money_sum("total_spent").alias("total_spent"),
        )
        .withColumn("risk_share", F.col("at_risk") / F.col("customers"))
        .orderBy(F.desc("risk_share"), group)
    )
