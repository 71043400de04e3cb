"""What must hold of fitted models, as rows with a SQL counterpart: expected counts, and no violations.

Weights, trees and centres depend on the solver, so SQL cannot state them; it states what each of them must satisfy.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.operators import anomalies, churn, models, oversampling, reports, risk, segments
from tallymart.operators.evaluation import classification_metrics
from tallymart.operators.scaling import churn_stages
from tallymart.plans import sql_parts as q
from tallymart.plans.models import CONFIGURED, LOGISTIC
from tallymart.plans.registry import query
from tallymart.plans.risk import base, risks
from tallymart.plans.sales import features
from tallymart.session import scratch_path, stable
from tallymart.sources import feeds

#: Test rows of the churn split: a hash of the key at or above the train share.
_HELD = "md5(customer_id || '|42') >= 'cccccccd'"


def violations(df: DataFrame, **rules) -> DataFrame:
    """One row: how many rows there are, and how many break each rule."""
    broken = [F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()]
    return df.agg(F.count(F.lit(1)).alias("rows"), *broken)


def gradient(vectors: DataFrame, label: str, model, penalty: list[float]) -> DataFrame:
    """(entry, slope) of the mean log loss plus half the penalised squared weights; the last entry is the intercept."""
    weights = [float(w) for w in model.coefficients]
    x = vector_to_array("features")
    linear = F.lit(float(model.intercept))
    for i, w in enumerate(weights):
        linear = linear + x[i] * w
    error = 1 / (1 + F.exp(-linear)) - F.col(label)
    means = [F.avg(error * x[i]).alias(f"g{i}") for i in range(len(weights))] + [F.avg(error).alias(f"g{len(weights)}")]
    row = vectors.agg(*means)
    slopes = [F.col(f"g{i}") + (penalty[i] * weights[i] if i < len(weights) else 0.0) for i in range(len(weights) + 1)]
    return row.select(F.posexplode(F.array(*slopes)).alias("entry", "slope"))


@query('SELECT 8 AS "rows", 0 AS not_flat')
def churn_gradient(t):
    """At the fitted weights the penalised loss has no slope; a weight's penalty grows with its feature's variance."""
    rows = churn.model_rows(features(t))
    stages, names = churn_stages(rows)
    for i, stage in enumerate(stages):
        if hasattr(stage, "fit"):
            stages[i] = stage.fit(rows)
        rows = stages[i].transform(rows)
    vectors = stable(rows.select("features", "is_churned"))
    strength = 0.5
    fitted = models.LogisticRegression(featuresCol="features", labelCol="is_churned", maxIter=500, regParam=strength, tol=1e-10)
    model = fitted.fit(vectors)
    x = vector_to_array("features")
    spread = vectors.agg(*[F.stddev_samp(x[i]) for i in range(len(names))]).first()
    penalty = [strength * s * s for s in spread]
    slopes = gradient(vectors, "is_churned", model, penalty)
    scaled = F.abs("slope") / F.element_at(F.array(*[F.lit(max(float(s), 1e-9)) for s in [*spread, 1.0]]), F.col("entry") + 1)
    found = violations(slopes, not_flat=scaled < 1e-3)
    return found.select((F.col("rows") - 1).alias("rows"), "not_flat")


@query('SELECT 6 AS "rows", 0 AS not_flat')
def risk_gradient(t):
    """The strength C weighs the summed loss: the slope of the mean loss plus w / (C n) vanishes."""
    rows = risk.select_features(risks(t)).fillna(0, subset=risk.RISK_FEATURES)
    scaled = rows.select("composite_risk", *[(F.col(c) / F.lit(1000.0)).alias(c) for c in risk.RISK_FEATURES])
    vectors = stable(VectorAssembler(inputCols=risk.RISK_FEATURES, outputCol="features").transform(scaled).select("features", "composite_risk"))
    n = vectors.count()
    params = {**LOGISTIC, "C": 0.01, "tol": 1e-12}
    model = models.make_classifier("LogisticRegression", n, "composite_risk", params).fit(vectors)
    slopes = gradient(vectors, "composite_risk", model, [1 / (0.01 * n)] * len(risk.RISK_FEATURES))
    return violations(slopes, not_flat=F.abs("slope") < 1e-3)


@query('SELECT 6 AS "rows", 0 AS not_flat')
def configured_gradient(t):
    """The whole parameter set of the classifier configuration trains, and its weights minimise the same function."""
    rows = risk.select_features(risks(t)).fillna(0, subset=risk.RISK_FEATURES)
    scaled = rows.select("composite_risk", *[(F.col(c) / F.lit(1000.0)).alias(c) for c in risk.RISK_FEATURES])
    vectors = stable(VectorAssembler(inputCols=risk.RISK_FEATURES, outputCol="features").transform(scaled).select("features", "composite_risk"))
    n = vectors.count()
    model = models.make_classifier("LogisticRegression", n, "composite_risk", CONFIGURED).fit(vectors)
    slopes = gradient(vectors, "composite_risk", model, [1 / (CONFIGURED["C"] * n)] * len(risk.RISK_FEATURES))
    return violations(slopes, not_flat=F.abs("slope") < 1e-3)


def walked(vectors: DataFrame, nodes: DataFrame, trees: int, depth: int, key: str = "customer_id") -> DataFrame:
    """(key, votes) from the node table of a saved forest: each row walks down each tree, leaves add class shares."""
    own = nodes.select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("node"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("entry"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("limit"),
        F.col("nodeData.impurityStats").alias("counts"),
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    at = vectors.select(key, vector_to_array("features").alias("x"), F.lit(0).alias("node"), every)
    for _ in range(depth):
        here = at.join(own.select("tree", "node", "left", "right", "entry", "limit"), ["tree", "node"])
        goes = F.when(F.col("left") < 0, F.col("node")).when(F.get("x", F.col("entry")) <= F.col("limit"), F.col("left")).otherwise(F.col("right"))
        at = here.select(key, "x", "tree", goes.alias("node"))
    leaves = at.join(own.select("tree", "node", "counts"), ["tree", "node"])
    share = F.get("counts", F.lit(1)) / F.aggregate("counts", F.lit(0.0), lambda a, c: a + c)
    return leaves.groupBy(key).agg(F.avg(share).alias("votes"))


@query(
    f"""WITH {q.RISK}, sizes AS (SELECT composite_risk, count(*) AS n FROM risk GROUP BY composite_risk)
SELECT sum(round(0.3::DOUBLE * n))::BIGINT AS "rows", 0 AS wrong_score, 0 AS wrong_class FROM sizes"""
)
def forest_votes(t):
    """The forest's scores and classes are what its saved trees vote on the test rows."""
    params = {"n_estimators": 7, "max_depth": 4, "random_state": 42}
    trained = models.train_risk_model(risks(t), "RandomForestClassifier", params)
    path = scratch_path(t.spark, "forest")
    trained.model.stages[-1].write().overwrite().save(path)
    votes = walked(trained.predictions, t.spark.read.parquet(f"{path}/data"), params["n_estimators"], params["max_depth"])
    both = models.scored_rows(trained.predictions, "composite_risk").join(votes, "customer_id")
    return violations(
        both,
        wrong_score=F.abs(F.col("score") - F.col("votes")) < 1e-9,
        wrong_class=(F.col("prediction") == (F.col("votes") > 0.5).cast("int")) | (F.abs(F.col("votes") - 0.5) < 1e-9),
    )


@query(
    f"""WITH {q.FEATURES} SELECT 'logistic_regression' AS model, 8 AS features_count,
  strftime(max(analysis_reference_date), '%Y-%m-%d') AS "day", 0 AS wrong_auc, 0 AS wrong_f1 FROM features"""
)
def metrics_row_agrees(t):
    """The row of the metrics history holds what Spark's own evaluators say of the same test rows."""
    trained = models.train_churn_model(features(t))
    stamp = dt.datetime.combine(t.orders.agg(F.max(F.col("o_orderdate").cast("date"))).first()[0], dt.time())
    row = reports.metrics_row(t.spark, "logistic_regression", trained.metrics, len(trained.features), stamp)
    rows = trained.predictions.withColumns({"is_churned": F.col("is_churned").cast("double"), "one": vector_to_array("probability")[1]})
    area = BinaryClassificationEvaluator(labelCol="is_churned", rawPredictionCol="one").setParams(numBins=0).evaluate(rows)
    f1 = MulticlassClassificationEvaluator(labelCol="is_churned", metricName="f1").evaluate(rows)
    return row.select(
        "model",
        "features_count",
        F.date_format("timestamp", "yyyy-MM-dd").alias("day"),
        (F.abs(F.col("auc") - area) > 1e-6).cast("int").alias("wrong_auc"),
        (F.abs(F.col("f1") - f1) > 1e-9).cast("int").alias("wrong_f1"),
    )


@query(
    f"""WITH {q.FEATURES}, held AS (SELECT customer_id, is_churned FROM features WHERE {_HELD} ORDER BY customer_id LIMIT 50)
SELECT customer_id, is_churned AS actual, true AS as_weighed FROM held"""
)
def prediction_sample_classes(t):
    """The predicted column of the sample is the side of zero on which weights and features put the customer."""
    trained = models.train_churn_model(features(t))
    model = trained.model.stages[-1]
    x, linear = vector_to_array("features"), F.lit(float(model.intercept))
    for i, w in enumerate(model.coefficients):
        linear = linear + x[i] * float(w)
    sides = trained.predictions.select("customer_id", (linear > 0).cast("int").alias("side"))
    sample = models.predictions_sample(trained.predictions, "is_churned", 50).join(sides, "customer_id")
    return sample.select("customer_id", "actual", (F.col("predicted") == F.col("side")).alias("as_weighed"))


@query(
    f"""WITH {q.RISK}, sizes AS (SELECT composite_risk, count(*) AS n FROM risk GROUP BY composite_risk)
SELECT i::INT AS fold, sum(n * (i + 1) // 4 - n * i // 4)::BIGINT AS "rows", 0 AS wrong_f1 FROM sizes, range(4) r(i) GROUP BY i"""
)
def fold_scores_agree(t):
    """Every row is scored in its fold; a fold's F1 is the one that the classification metrics give on its predictions."""
    rows = risk.select_features(risks(t)).fillna(0, subset=risk.RISK_FEATURES)
    scored = models.cross_validated_predictions(rows, risk.RISK_FEATURES, "composite_risk", folds=4, params=LOGISTIC)
    sizes = scored.groupBy("fold").agg(F.count(F.lit(1)).alias("rows"))
    parts = [classification_metrics(scored.where(F.col("fold") == k)).select(F.lit(k).alias("fold"), "f1_binary") for k in range(4)]
    both = models.fold_scores(scored, 4).join(sizes, "fold").join(reduce(DataFrame.unionByName, parts), "fold")
    return both.select("fold", "rows", (F.abs(F.col("f1") - F.col("f1_binary")) > 1e-12).cast("int").alias("wrong_f1"))


@query(f'WITH {q.BASE} SELECT count(*) AS "rows", 0 AS not_nearest, 0 AS unnumbered FROM base')
def segment_centres(t):
    """Every customer, also one without measures, is in the segment of the nearest centre."""
    rows = base(t).withColumn("total_spent", F.when(F.col("customer_id").cast("bigint") % 19 != 0, F.col("total_spent")))
    model = segments.fit_segments(rows, restarts=3)
    point = vector_to_array("_scaled")
    far = [
        sum(((point[i] - c) * (point[i] - c) for i, c in enumerate(centre)), F.lit(0.0)) for centre in model.centres()
    ]
    scaled = model.scaled(rows).select("customer_id", F.array(*far).alias("far"))
    named = model.transform(rows).select("customer_id", "cluster")
    own = F.element_at("far", F.col("cluster").cast("int") + 1)
    both = scaled.join(named, "customer_id")
    return violations(both, not_nearest=own <= F.array_min("far") + 1e-9, unnumbered=F.col("cluster").isin("0", "1", "2"))


@query(
    f"""WITH {q.BASE} SELECT count(*) AS "rows", 0 AS wrong_flag, 0 AS wrong_score, true AS share_kept FROM base"""
)
def anomaly_order(t):
    """Flagged rows have the largest degrees, at most a tenth of all, and rows without measures are scored."""
    rows = base(t).withColumn("total_spent", F.when(F.col("customer_id").cast("bigint") % 19 != 0, F.col("total_spent")))
    model, scored = anomalies.fit_anomalies(rows, trees=30)
    flagged = model.flag(scored)
    least = flagged.where("is_anomaly = 1").agg(F.min("anomaly_degree")).scalar()
    most = flagged.where("is_anomaly = 0").agg(F.max("anomaly_degree")).scalar()
    found = violations(
        flagged.withColumns({"_least": least, "_most": most}),
        wrong_flag=F.col("_least").isNull() | (F.col("_least") > F.col("_most")),
        wrong_score=(F.col("anomaly_score") == 1 - 2 * F.col("is_anomaly")) & F.col("anomaly_degree").between(0, 1),
    )
    share = flagged.agg(F.avg("is_anomaly")).scalar()
    return found.withColumn("share_kept", share <= 0.1)


@query(
    f"""WITH {q.RISK}, sizes AS (SELECT composite_risk, count(*) AS n FROM risk GROUP BY composite_risk)
SELECT (max(n) - min(n))::BIGINT AS "rows", 0 AS outside FROM sizes"""
)
def synthetic_bounds(t):
    """Synthetic rows lie within the range of the minority in every feature."""
    rows = risks(t)
    made = oversampling.oversample_minority(rows, risk.RISK_FEATURES, "composite_risk", "customer_id").where("is_synthetic = 1")
    ends = [f(F.col(c).cast("double")).alias(f"{c}_{n}") for c in risk.RISK_FEATURES for n, f in (("low", F.min), ("high", F.max))]
    ranges = rows.groupBy("composite_risk").agg(*ends)
    inside = F.lit(True)
    for c in risk.RISK_FEATURES:
        inside = inside & F.col(c).between(F.col(f"{c}_low") - 1e-9, F.col(f"{c}_high") + 1e-9)
    return violations(made.join(ranges, "composite_risk"), outside=inside)


@query('SELECT 5 AS "rows", 0 AS out_of_range, 0 AS wrong_summary')
def cv_summary(t):
    """The folds are complete; the summary is their mean and twice their population deviation."""
    rows = risk.select_features(risks(t))
    scores = stable(models.cross_validated_f1(rows, risk.RISK_FEATURES, "composite_risk", params=LOGISTIC))
    summary = models.cross_validation_summary(scores).first()
    n = F.count(F.lit(1))
    mean = F.sum("f1") / n
    variance = F.greatest(F.sum(F.col("f1") * F.col("f1")) / n - mean * mean, F.lit(0.0))
    wrong = (F.abs(mean - summary["mean_f1"]) > 1e-9) | (F.abs(2 * F.sqrt(variance) - summary["two_std"]) > 1e-6)
    return scores.agg(n.alias("rows"), F.count_if(~F.col("f1").between(0, 1)).alias("out_of_range"), wrong.cast("int").alias("wrong_summary"))


@query(
    """SELECT 'weights' AS report, 8::BIGINT AS "rows", 0::BIGINT AS unordered, 1.0::DOUBLE AS total
UNION ALL SELECT 'top weights', 3, 0, 1.0 UNION ALL SELECT 'importances', 5, 0, 1.0"""
)
def report_order(t):
    """Reports list the largest first, all entries or the wanted number; importances sum to 1."""
    trained = models.train_churn_model(features(t))
    params = {"n_estimators": 5, "max_depth": 4, "random_state": 42}
    forest = models.train_risk_model(risks(t), "RandomForestClassifier", params)
    rows = []
    for name, table, size in (
        ("weights", reports.feature_weights(t.spark, trained.model, trained.features), "absolute_importance"),
        ("top weights", reports.feature_weights(t.spark, trained.model, trained.features, top=3), "absolute_importance"),
        ("importances", reports.importance_report(t.spark, forest.model, forest.features), "importance"),
    ):
        values = [r[size] for r in table.collect()]
        unordered = sum(a < b for a, b in zip(values, values[1:], strict=False))
        rows.append((name, len(values), unordered, round(sum(values), 9) if name == "importances" else 1.0))
    return t.spark.createDataFrame(rows, "report string, rows bigint, unordered bigint, total double")


@query(
    f"""WITH {q.FEATURES} SELECT (SELECT d FROM as_of)::VARCHAR AS report_date, count(*) AS total_customers_analyzed,
  sum(is_churned)::BIGINT AS churned_customers, round(sum(is_churned) / count(*), 4) AS churn_rate FROM features"""
)
def summary_business_numbers(t):
    """The churn totals inside the summary document."""
    day = t.orders.agg(F.max(F.col("o_orderdate").cast("date"))).first()[0]
    content = reports.metrics_summary(features(t), {"auc": 0.5, "f1": 0.5}, day)
    schema = "report_date string, business_metrics struct<total_customers_analyzed: bigint, churned_customers: bigint, churn_rate: double>"
    return content.select(F.from_json("content", schema).alias("d")).select("d.report_date", "d.business_metrics.*")


@query(f"WITH {q.FEATURES} SELECT customer_id, is_churned AS actual FROM features WHERE {_HELD} ORDER BY customer_id LIMIT 50")
def prediction_sample_rows(t):
    """Keys and actual classes of a sample of the scored test rows; the sample's size is the caller's."""
    trained = models.train_churn_model(features(t))
    return models.predictions_sample(trained.predictions, "is_churned", 50).select("customer_id", "actual")


@query(
    f"""WITH {q.FEATURES}, gapped AS (SELECT customer_id, customer_id::BIGINT AS c FROM features)
SELECT customer_id FROM gapped WHERE c % 5 <> 0 AND c % 7 <> 0 AND c % 11 <> 0 AND c % 13 <> 0"""
)
def model_rows_with_gaps(t):
    """Rows lacking any of the four base measures are no model rows."""
    c = F.col("customer_id").cast("bigint")
    table = features(t)
    for prime, name in zip((5, 7, 11, 13), churn.ML_REQUIRED, strict=True):
        table = table.withColumn(name, F.when(c % prime != 0, F.col(name)))
    return churn.model_rows(table).select("customer_id")


@query(
    f"""WITH {q.FEATURES} SELECT customer_id, DATE '2024-02-03' AS processing_date, '2024-02-03 04:05:06' AS processed,
  analysis_reference_date FROM features"""
)
def audited_features(t):
    """Audit columns at a given time; operators never read the clock."""
    at = dt.datetime(2024, 2, 3, 4, 5, 6)
    table = churn.churn_features(feeds.transactions(t), feeds.known_customers(t), feeds.last_order_day(t), processed_at=at)
    processed = F.date_format("processing_timestamp", "yyyy-MM-dd HH:mm:ss").alias("processed")
    return table.select("customer_id", "processing_date", processed, "analysis_reference_date")
