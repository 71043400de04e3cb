"""Sums and means of money that do not depend on the order of the rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast(MONEY)


def money_sum(column: str) -> Column:
    return F.sum(money(column)).cast("double")


def money_avg(column: str) -> Column:
    return ratio(F.sum(money(column)), F.count(column))


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double, NULL when ``whole`` is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double")), digits)
