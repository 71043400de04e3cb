"""Retail and churn analytics as PySpark DataFrame operators."""
