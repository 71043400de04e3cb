import datetime as dt
import json

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tallymart.operators import churn, models, reports, risk
from tallymart.session import stable
from tallymart.sources import feeds, readers, writers


@pytest.fixture(scope="module")
def features(tables):
    return stable(churn.churn_features(feeds.transactions(tables), feeds.known_customers(tables)))


@pytest.fixture(scope="module")
def trained(features):
    return models.train_churn_model(features)


def newton(x, y, c):
    """Minimise the summed log loss plus half the squared weights over c, with a free intercept."""
    data = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.diag([1.0 / c] * x.shape[1] + [0.0])
    w = np.zeros(data.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-data @ w))
        step = np.linalg.solve(data.T @ (data * (p * (1 - p))[:, None]) + penalty, data.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-12:
            break
    return w


def test_logistic_strength_matches_a_newton_solve(spark):
    draw = np.random.default_rng(7)
    x = draw.normal(0, 1, (400, 2))
    y = (x @ [1.0, -2.0] + draw.normal(0, 1, 400) > 0.3).astype(int)
    rows = [(float(a), float(b), int(t)) for (a, b), t in zip(x, y, strict=True)]
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.createDataFrame(rows, "a double, b double, y int"))
    for strength in (0.1, 1.0, 10.0):
        model = models.make_classifier("LogisticRegression", 400, "y", {"C": strength, "max_iter": 1000}).fit(df)
        expected = newton(x, y, strength)
        assert [*model.coefficients, model.intercept] == pytest.approx(list(expected), abs=2e-3)


@pytest.mark.parametrize("solver", ["lbfgs", "newton-cg", "saga"])
def test_solvers_of_the_same_problem_are_accepted(spark, solver):
    params = {"random_state": 42, "max_iter": 1000, "C": 1.0, "solver": solver}
    classifier = models.make_classifier("LogisticRegression", 400, "y", params)
    assert classifier.getMaxIter() == 1000 and classifier.getRegParam() == pytest.approx(1 / 400)


def test_churn_model(trained):
    assert trained.metrics["auc"] > 0.9
    assert trained.features[-1] == "region_index"
    assert trained.predictions.where("split <> 'test'").count() == 0


def test_leaky_feature_can_be_left_out(features, trained):
    honest = models.train_churn_model(features, exclude_leaky=True)
    assert "days_since_last_tx" not in honest.features
    assert honest.metrics["auc"] < trained.metrics["auc"]


def test_saved_pipeline_scores_as_before(features, trained, tmp_path):
    path = str(tmp_path / "model")
    writers.save_model(trained.model, path)
    writers.save_model(trained.model, path)  # overwrites
    raw = features.join(trained.predictions.select("customer_id"), "customer_id")
    again = models.scored_rows(PipelineModel.load(path).transform(raw), "is_churned").orderBy("customer_id").collect()
    assert again == models.scored_rows(trained.predictions, "is_churned").orderBy("customer_id").collect()


def test_weights_report(spark, trained):
    rows = reports.feature_weights(spark, trained.model, trained.features).collect()
    sizes = [r["absolute_importance"] for r in rows]
    assert sizes == sorted(sizes, reverse=True) and {r["feature"] for r in rows} == set(trained.features)
    assert reports.feature_weights(spark, trained.model, trained.features, top=3).count() == 3


def test_metrics_history_and_document(spark, features, trained, tmp_path):
    path = str(tmp_path / "history")
    for day in (1, 2):
        stamp = dt.datetime(2024, 1, day)
        writers.append_json(reports.metrics_row(spark, "m", trained.metrics, len(trained.features), stamp), path)
    history = readers.read_json(spark, path, "model string, auc double, f1 double, timestamp timestamp, features_count int")
    assert history.count() == 2 and history.first()["features_count"] == len(trained.features)
    text = reports.metrics_summary(features, trained.metrics, dt.date(2024, 1, 2)).first()["content"]
    summary = json.loads(text)
    assert summary["report_date"] == "2024-01-02"
    assert summary["business_metrics"]["total_customers_analyzed"] == features.count()


def test_risk_models(spark, risks):
    linear = models.train_risk_model(risks, params={"C": 1.0, "max_iter": 1000})
    assert linear.metrics["auc"] > 0.8
    forest = models.train_risk_model(
        risks, "RandomForestClassifier", {"n_estimators": 5, "max_depth": 4, "random_state": 1}, balance=False
    )
    report = reports.importance_report(spark, forest.model, forest.features)
    assert sum(r["importance"] for r in report.collect()) == pytest.approx(1.0)
    assert reports.importance_report(spark, linear.model, linear.features).columns[2] == "abs_importance"
    sample = models.predictions_sample(linear.predictions, "composite_risk", 10).collect()
    assert len(sample) == 10 and [r["customer_id"] for r in sample] == sorted(r["customer_id"] for r in sample)
    with pytest.raises(ValueError):
        models.make_classifier("Other", 1, "y")


def test_model_without_weights_has_no_report(spark, trained):
    assert reports.importance_report(spark, PipelineModel(trained.model.stages[:-1]), []) is None


def test_cross_validation(risks):
    rows = risk.select_features(risks)
    scores = models.cross_validated_f1(rows, risk.RISK_FEATURES, "composite_risk", folds=3)
    values = [r["f1"] for r in scores.collect()]
    summary = models.cross_validation_summary(scores).first()
    assert len(values) == 3 and summary["mean_f1"] == pytest.approx(np.mean(values))
    assert summary["two_std"] == pytest.approx(2 * np.std(values))


def test_risk_features_follow_the_table(risks):
    chosen = risk.select_features(risks.drop("total_spent"))
    assert chosen.columns == [
        "customer_id", "days_since_last_transaction", "transactions_last_90d", "total_transactions",
        "avg_transaction_amount", "composite_risk",
    ]
    assert risk.feature_names(risks, exclude_leaky=True) == ["total_transactions", "avg_transaction_amount"]


def test_missing_measures_carry_no_risk(spark):
    rows = [(str(i), float(i), float(i), float(i)) for i in range(4)] + [("x", None, None, None)]
    df = spark.createDataFrame(
        rows, "customer_id string, days_since_last_transaction double, total_spent double, transactions_last_90d double"
    )
    found = {r["customer_id"]: r["composite_risk"] for r in risk.composite_risk(df).select("customer_id", "composite_risk").collect()}
    assert found == {"0": 1, "1": 1, "2": 0, "3": 0, "x": 0}


@pytest.mark.parametrize(
    ("kind", "params", "name", "value"),
    [
        ("LogisticRegression", {"penalty": "l1"}, "elasticNetParam", 1.0),
        ("LogisticRegression", {"penalty": "elasticnet", "l1_ratio": 0.25}, "elasticNetParam", 0.25),
        ("LogisticRegression", {"penalty": None}, "regParam", 0.0),
        ("LogisticRegression", {"C": 2.0}, "regParam", 0.005),
        ("LogisticRegression", {"tol": 1e-3}, "tol", 1e-3),
        ("LogisticRegression", {"fit_intercept": False}, "fitIntercept", False),
        ("LogisticRegression", {"max_iter": 7, "random_state": 1, "n_jobs": 2}, "maxIter", 7),
        ("RandomForestClassifier", {"min_samples_leaf": 4}, "minInstancesPerNode", 4),
        ("RandomForestClassifier", {"max_features": "log2"}, "featureSubsetStrategy", "log2"),
        ("RandomForestClassifier", {"max_features": None}, "featureSubsetStrategy", "all"),
        ("RandomForestClassifier", {"criterion": "entropy"}, "impurity", "entropy"),
        ("RandomForestClassifier", {"max_samples": 0.5}, "subsamplingRate", 0.5),
        ("RandomForestClassifier", {"n_estimators": 3}, "numTrees", 3),
        ("RandomForestClassifier", {"max_depth": 2, "bootstrap": False}, "maxDepth", 2),
    ],
)
def test_each_parameter_has_its_counterpart(spark, kind, params, name, value):
    assert models.make_classifier(kind, 100, "y", params).getOrDefault(name) == value


@pytest.mark.parametrize(
    ("kind", "params"),
    [
        ("LogisticRegression", {"class_weight": "balanced"}),
        ("LogisticRegression", {"penalty": "l3"}),
        ("LogisticRegression", {"penalty": "elasticnet"}),
        ("LogisticRegression", {"solver": "liblinear"}),
        ("LogisticRegression", {"solver": "lbfgs", "penalty": "l1"}),
        ("RandomForestClassifier", {"class_weight": "balanced"}),
        ("RandomForestClassifier", {"max_leaf_nodes": 4}),
    ],
)
def test_other_parameters_are_refused(spark, kind, params):
    with pytest.raises(ValueError):
        models.make_classifier(kind, 100, "y", params)


def test_customers_with_one_transaction_are_scored(features):
    deviation = F.when(F.col("customer_id").cast("bigint") % 9 != 0, F.col("std_tx_amount"))
    features = stable(features.withColumn("std_tx_amount", deviation))
    filled, skipped = models.train_churn_model(features), models.train_churn_model(features, gaps="skip")
    assert "std_missing" in filled.features and "std_missing" not in skipped.features
    lone = features.where("std_tx_amount IS NULL").select("customer_id")
    assert skipped.predictions.join(lone, "customer_id").count() == 0
    assert filled.predictions.count() - skipped.predictions.count() == filled.predictions.join(lone, "customer_id").count()
