"""Trained models and their reports. Their numbers have no SQL counterpart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallymart.operators import models, reports, risk
from tallymart.plans.registry import query
from tallymart.plans.risk import risks
from tallymart.plans.sales import features
from tallymart.session import stable

# The parameters of the logistic classifier configuration.
CONFIGURED = {"random_state": 42, "max_iter": 1000, "C": 1.0, "solver": "lbfgs"}
LOGISTIC = {"C": 1.0, "max_iter": 1000}


def _day(t) -> dt.date:
    return t.orders.agg(F.max(F.col("o_orderdate").cast("date"))).first()[0]


@query()
def churn_model_metrics(t):
    trained = models.train_churn_model(features(t))
    stamp = dt.datetime.combine(_day(t), dt.time())
    return reports.metrics_row(t.spark, "logistic_regression", trained.metrics, len(trained.features), stamp)


@query()
def churn_model_without_recency(t):
    trained = models.train_churn_model(features(t), exclude_leaky=True)
    stamp = dt.datetime.combine(_day(t), dt.time())
    return reports.metrics_row(t.spark, "logistic_regression", trained.metrics, len(trained.features), stamp)


@query()
def feature_weights(t):
    trained = models.train_churn_model(features(t))
    return reports.feature_weights(t.spark, trained.model, trained.features)


@query()
def metrics_summary(t):
    table = stable(features(t))
    return reports.metrics_summary(table, models.train_churn_model(table).metrics, _day(t))


@query()
def churn_predictions_sample(t):
    return models.predictions_sample(models.train_churn_model(features(t)).predictions, "is_churned", limit=100)


@query()
def risk_model_metrics(t):
    trained = models.train_risk_model(risks(t), params=CONFIGURED)
    names = ["accuracy", "f1_binary", "auc"]
    return t.spark.createDataFrame([(n, float(trained.metrics[n])) for n in names], "metric string, value double")


@query()
def forest_importance(t):
    params = {"n_estimators": 20, "max_depth": 5, "random_state": 42}
    trained = models.train_risk_model(risks(t), "RandomForestClassifier", params)
    return reports.importance_report(t.spark, trained.model, trained.features)


@query()
def cv_scores(t):
    rows = risk.select_features(risks(t))
    train = models.stratified_split(rows, "customer_id", "composite_risk").where("split = 'train'").drop("split")
    return models.cross_validated_f1(train, risk.RISK_FEATURES, "composite_risk", params=LOGISTIC)
