"""Equi-joins. Hot keys are left to adaptive execution, or collapse before the join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def client_columns(clients: DataFrame) -> DataFrame:
    """Rename the client's own city and tier, so that they do not clash with those of the order."""
    return clients.withColumnsRenamed({"city": "client_city", "loyalty_level": "client_loyalty"})


def join_detail(facts: DataFrame, dimension: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join detail rows to a dimension on ``key`` (``inner`` or ``left``).

    Spark broadcasts a small dimension and otherwise splits the partitions of a hot key at run time.
    """
    return facts.join(dimension, key, how)


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def keys_only_in(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks; NULL counts as a key like any other.

    Both sides are made distinct before the join, so a hot key costs one row per task.
    """
    known = distinct_keys(right, key).withColumnRenamed(key, "_known")
    return distinct_keys(left, key).join(known, F.col(key).eqNullSafe(F.col("_known")), "left_anti")
