"""Reads from the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_tables(spark: SparkSession, database: str) -> list[str]:
    """Names of the tables of a database, in order; empty when there is no such database.

    Temporary views belong to the session, not to a database, and are left out.
    """
    if not spark.catalog.databaseExists(database):
        return []
    return sorted(table.name for table in spark.catalog.listTables(database) if not table.isTemporary)


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE FORMATTED {table}")


def first_rows(df: DataFrame, key: str, limit: int | None) -> DataFrame:
    """All rows, or with ``limit`` those with the smallest keys: a sample that is the same on every run."""
    return df if limit is None else df.orderBy(key).limit(limit)


def customer_rows(spark: SparkSession, table: str, limit: int | None = None, key: str = "customer_id") -> DataFrame:
    return first_rows(spark.table(table), key, limit)


def labelled_rows(
    spark: SparkSession, table: str, label: str = "churn_label", limit: int | None = None, key: str = "customer_id"
) -> DataFrame:
    return first_rows(spark.table(table).where(F.col(label).isNotNull()), key, limit)
