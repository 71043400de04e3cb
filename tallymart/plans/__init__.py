"""The registered queries and their SQL counterparts."""

from tallymart.plans import cleaning, evaluation, models, profiling, properties, risk, sales, storage  # noqa: F401
from tallymart.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
