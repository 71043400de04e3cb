import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tallymart.operators import evaluation

SCHEMA = "label int, score double, prediction int"


def pairwise_auc(rows):
    pos = [s for y, s, _ in rows if y == 1]
    neg = [s for y, s, _ in rows if y == 0]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


scored = st.lists(st.tuples(st.integers(0, 1), st.sampled_from([0.1, 0.2, 0.5, 0.9]), st.integers(0, 1)), max_size=20)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(scored)
def test_auc_equals_the_pairwise_definition(spark, extra):
    rows = [(0, 0.3, 0), (1, 0.4, 1), *extra]
    found = evaluation.auc(spark.createDataFrame(rows, SCHEMA)).first()["auc"]
    assert 0 <= found <= 1 and found == pytest.approx(pairwise_auc(rows))


def test_agrees_with_spark_evaluators(spark):
    draw = random.Random(1)
    rows = [(draw.randint(0, 1), draw.random(), draw.randint(0, 1)) for _ in range(500)]
    df = spark.createDataFrame(rows, SCHEMA)
    ml = df.select("label", F.col("score").alias("rawPrediction"), F.col("prediction").cast("double"))
    auc = BinaryClassificationEvaluator(labelCol="label", numBins=0).evaluate(ml)
    assert evaluation.auc(df).first()["auc"] == pytest.approx(auc)
    ours = evaluation.classification_metrics(df).first()

    def spark_says(name, **extra):
        return MulticlassClassificationEvaluator(labelCol="label", metricName=name, **extra).evaluate(ml)

    assert ours["f1_weighted"] == pytest.approx(spark_says("f1"))
    assert ours["accuracy"] == pytest.approx(spark_says("accuracy"))
    assert ours["f1_binary"] == pytest.approx(spark_says("fMeasureByLabel", metricLabel=1.0))


def test_roc_runs_from_origin_to_one(spark):
    draw = random.Random(2)
    rows = [(draw.randint(0, 1), float(draw.randint(0, 30)), 0) for _ in range(300)]
    points = evaluation.roc_points(spark.createDataFrame(rows, SCHEMA)).collect()
    ordered = sorted(points, key=lambda p: float("inf") if p["threshold"] is None else p["threshold"], reverse=True)
    assert (ordered[0]["fpr"], ordered[0]["tpr"]) == (0.0, 0.0)
    assert (ordered[-1]["fpr"], ordered[-1]["tpr"]) == (1.0, 1.0)
    area = sum((b["fpr"] - a["fpr"]) * (a["tpr"] + b["tpr"]) / 2 for a, b in zip(ordered, ordered[1:], strict=False))
    assert area == pytest.approx(pairwise_auc(rows))


def test_one_class_gives_no_auc(spark):
    df = spark.createDataFrame([(1, 0.2, 1), (1, 0.4, 1)], SCHEMA)
    assert evaluation.auc(df).first()["auc"] is None
    report = {r["class"]: r for r in evaluation.class_report(df).collect()}
    assert report["1"]["f1"] == 1.0 and "0" not in report
