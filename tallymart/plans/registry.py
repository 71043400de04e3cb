"""Registered queries: each takes the test tables and returns a DataFrame; most have a SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.sources.feeds import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of the tables under its own name."""

    def register(fn: Callable[[Tables], DataFrame]):
        name = fn.__name__
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round sums of floating-point numbers, whose last digits depend on the order of addition."""
    return df.withColumns({c: F.round(c, digits) for c in columns})
