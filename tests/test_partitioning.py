"""Results must not depend on how the input is partitioned."""

import pytest
from pyspark.sql import functions as F

from tallymart.operators import cleaning, evaluation, marts, profile, risk
from tallymart.sources import feeds

END = "2001-08-01"


def same_for_all(df, operator):
    results = []
    for partitions in (1, 4, 16):
        found = operator(df.repartition(partitions))
        results.append(sorted((tuple(r) for r in found.collect()), key=repr))
    assert results[0] == results[1] == results[2]
    assert results[0]


OPERATORS = {
    "clean": lambda df: cleaning.clean_transactions(df, END),
    "statistics": lambda df: cleaning.cleaning_statistics(
        df, cleaning.transaction_rules(F.lit(END).cast("date")), cleaning.TRANSACTION_KEYS
    ),
    "activity": marts.customer_activity,
    "tx_stats": marts.transaction_statistics,
    "base": lambda df: risk.customer_base(df, END),
    "fence": lambda df: profile.outlier_fence(df, "tx_amount"),
    "outliers": lambda df: profile.outliers(df, "tx_amount"),
    "spikes": lambda df: profile.spike_days(df, "tx_date", 3.0),
    "busiest": lambda df: cleaning.frequency(df, "tx_date", 10),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_transaction_operators(tables, name):
    same_for_all(feeds.raw_transactions(tables), OPERATORS[name])


@pytest.mark.parametrize("name", ["roc_points", "auc", "class_report"])
def test_evaluation(risks, name):
    scored = risks.select(
        F.col("composite_risk").alias("label"),
        (F.col("days_since_last_transaction") / 1000).alias("score"),
        F.col("days_risk").alias("prediction"),
    )
    same_for_all(scored, getattr(evaluation, name))


def test_risk_labels(base):
    same_for_all(base, risk.composite_risk)
