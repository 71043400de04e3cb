"""Small reports on fitted models. Their rows are coefficients and metrics, never data."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.operators.churn import churn_totals


def feature_weights(spark: SparkSession, model: PipelineModel, names: list[str], top: int | None = None) -> DataFrame:
    """Signed weights of a linear model, largest absolute weight first."""
    weights = [float(w) for w in model.stages[-1].coefficients]
    rows = [(name, weight, abs(weight)) for name, weight in zip(names, weights, strict=True)]
    table = spark.createDataFrame(rows, "feature string, coefficient double, absolute_importance double")
    ranked = table.orderBy(F.desc("absolute_importance"), "feature")
    return ranked if top is None else ranked.limit(top)


def importance_report(spark: SparkSession, model: PipelineModel, names: list[str]) -> DataFrame | None:
    """Forest importances, or weights of a linear model, or None when the model has neither."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        shares = [float(v) for v in last.featureImportances.toArray()]
        table = spark.createDataFrame(list(zip(names, shares, strict=True)), "feature string, importance double")
        return table.orderBy(F.desc("importance"), "feature")
    if hasattr(last, "coefficients"):
        return feature_weights(spark, model, names).withColumnRenamed("absolute_importance", "abs_importance")
    return None


def metrics_row(
    spark: SparkSession, model_name: str, metrics: Mapping[str, float], features: int, finished_at: dt.datetime
) -> DataFrame:
    """One line for the metrics history."""
    return spark.createDataFrame(
        [(model_name, float(metrics["auc"]), float(metrics["f1"]), finished_at, features)],
        "model string, auc double, f1 double, timestamp timestamp, features_count int",
    )


def metrics_summary(features: DataFrame, metrics: Mapping[str, float], report_date: dt.date) -> DataFrame:
    """One JSON document with the model metrics and the churn totals of the data."""
    totals = churn_totals(features)
    return totals.select(
        F.to_json(
            F.struct(
                F.lit(report_date).alias("report_date"),
                F.struct(
                    F.lit(float(metrics["auc"])).alias("auc_score"), F.lit(float(metrics["f1"])).alias("f1_score")
                ).alias("model_metrics"),
                F.struct(
                    F.col("total_customers").alias("total_customers_analyzed"),
                    "churned_customers",
                    F.round("churn_rate", 4).alias("churn_rate"),
                ).alias("business_metrics"),
            )
        ).alias("content")
    )
