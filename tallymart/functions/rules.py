"""Predicates of the cleaning rules. A predicate may be NULL; callers read NULL as "fails"."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day(value: dt.date | str | Column) -> Column:
    """A date column from a date, an ISO string or a column."""
    return (value if isinstance(value, Column) else F.lit(value)).cast("date")


def latest(df: DataFrame, column: str) -> Column:
    """The largest value of ``column``, as a one-row scalar subquery (nothing is collected)."""
    return df.agg(F.max(column)).scalar()


def as_of_day(as_of: dt.date | str | Column | None, df: DataFrame, column: str) -> Column:
    """The given day, or the last day found in ``df``. Operators never read the wall clock."""
    return day(latest(df, column) if as_of is None else as_of)


def non_blank(column: str) -> Column:
    return F.length(F.trim(F.col(column))) > 0


def all_present(columns: list[str]) -> Column:
    """Every column NOT NULL, written so that the scan can use it."""
    present = F.col(columns[0]).isNotNull()
    for column in columns[1:]:
        present = present & F.col(column).isNotNull()
    return present


def within_days_before(column: str, as_of: Column, days: int) -> Column:
    """Between ``as_of - days`` and ``as_of``, both days included."""
    return (F.col(column) >= F.date_sub(as_of, days)) & (F.col(column) <= as_of)


def cap(column: str, limit: float) -> Column:
    """Values above ``limit`` become ``limit``; NULL stays NULL."""
    return F.when(F.col(column) > limit, F.lit(limit).cast("double")).otherwise(F.col(column))


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also where it is NULL)."""
    return F.when(condition, 1).otherwise(0)


def existing(df: DataFrame, wanted: list[str]) -> list[str]:
    """The wanted columns that ``df`` has, in the wanted order."""
    return [column for column in wanted if column in df.columns]
