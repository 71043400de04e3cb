"""Churn and risk classifiers on Spark ML.

Each fit is many short jobs over the same rows. The rows are stored first, so a job reads
stored vectors instead of carrying the lineage of the marts with every task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.defaults import (
    CHURN_MAX_ITER,
    CHURN_REG_PARAM,
    FOLDS,
    SEED,
    TEST_SHARE,
    TRAIN_SHARE,
)
from tallymart.operators.churn import model_rows
from tallymart.operators.evaluation import auc, classification_metrics
from tallymart.operators.oversampling import oversample_minority
from tallymart.operators.risk import feature_names, select_features
from tallymart.operators.scaling import churn_stages
from tallymart.operators.splits import hash_split, stratified_folds, stratified_split
from tallymart.session import in_parallel, stable


@dataclass
class Trained:
    """A fitted pipeline, the names of its vector entries, its scored test rows and its metrics."""

    model: PipelineModel
    features: list[str]
    predictions: DataFrame
    metrics: dict[str, float]


def scored_rows(predictions: DataFrame, label: str, key: str = "customer_id") -> DataFrame:
    """(key, label, score, prediction) from the output of a fitted classifier."""
    return predictions.select(
        key,
        F.col(label).cast("int").alias("label"),
        vector_to_array("probability")[1].alias("score"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def evaluate(predictions: DataFrame, label: str) -> dict[str, float]:
    """AUC on the full curve, class-weighted F1, F1 of class 1 and accuracy: one aggregate by score, one by class."""
    scored = scored_rows(predictions, label) if "probability" in predictions.columns else predictions
    counted = classification_metrics(scored).first()
    found = auc(scored).first()["auc"]
    return {
        "auc": float("nan") if found is None else found,
        "f1": counted["f1_weighted"],
        "f1_binary": counted["f1_binary"],
        "accuracy": counted["accuracy"],
    }


def train_churn_model(
    features: DataFrame,
    train_share: float = TRAIN_SHARE,
    seed: int = SEED,
    max_iter: int = CHURN_MAX_ITER,
    reg_param: float = CHURN_REG_PARAM,
    exclude_leaky: bool = False,
    gaps: str = "fill",
) -> Trained:
    """Logistic regression of ``is_churned``: stages and model are fitted on the train rows only.

    A customer with one transaction has no deviation; ``gaps`` says whether it counts as 0 with an entry of its
    own ("fill") or the customer is left out of training and of the scored rows ("skip").

    The flag is a function of the recency feature, so the default model separates almost perfectly;
    ``exclude_leaky`` trains without it.
    """
    stages, names = churn_stages(features, exclude_leaky, gaps)
    columns = [c for c in features.columns if c in {*names, "customer_id", "is_churned", "region"}]
    rows = stable(hash_split(model_rows(features).select(*columns), "customer_id", train_share, seed))
    prepared = Pipeline(stages=stages).fit(rows.where("split = 'train'"))
    train = stable(prepared.transform(rows.where("split = 'train'")).select("features", "is_churned"))
    classifier = LogisticRegression(
        featuresCol="features", labelCol="is_churned", maxIter=max_iter, regParam=reg_param
    )
    model = PipelineModel([*prepared.stages, classifier.fit(train)])
    scored = stable(model.transform(rows.where("split = 'test'")))
    return Trained(model, names, scored, evaluate(scored, "is_churned"))


# Parameter names of the classifier configuration.
LOGISTIC_PARAMS = {"C", "max_iter", "tol", "fit_intercept", "penalty", "l1_ratio", "solver"}
# Solver names of the classifier configuration and the penalties each of them takes. All solve the
# same problem, which Spark solves by L-BFGS, or by OWL-QN where the penalty has a corner.
SOLVERS = {
    "lbfgs": {None, "none", "l2"},
    "newton-cg": {None, "none", "l2"},
    "newton-cholesky": {None, "none", "l2"},
    "sag": {None, "none", "l2"},
    "saga": {None, "none", "l2", "l1", "elasticnet"},
}
FOREST_PARAMS = {
    "n_estimators": "numTrees",
    "max_depth": "maxDepth",
    "random_state": "seed",
    "min_samples_leaf": "minInstancesPerNode",
    "max_features": "featureSubsetStrategy",
    "criterion": "impurity",
    "max_samples": "subsamplingRate",
    "bootstrap": "bootstrap",
    "min_impurity_decrease": "minInfoGain",
}
# Settings of a run that change no result here.
RUN_PARAMS = {"n_jobs", "verbose", "warm_start"}


def _known(params: dict, names: set[str], kind: str) -> dict:
    refused = sorted(set(params) - names - RUN_PARAMS)
    if refused:
        raise ValueError(f"{kind} has no counterpart for: {', '.join(refused)}")
    return {k: v for k, v in params.items() if k in names}


def make_classifier(kind: str, rows: int, label: str, params: dict | None = None):
    """``LogisticRegression`` or ``RandomForestClassifier`` from the parameters of a configuration.

    The strength C weighs the summed loss against half the squared weights; Spark averages the loss,
    hence ``regParam = 1 / (C * rows)`` on unscaled features. A solver is accepted if it minimises the same
    function; the one that does not (liblinear penalises the intercept) is refused, as is what Spark cannot express.
    """
    params = dict(params or {})
    if kind == "LogisticRegression":
        params.pop("random_state", None)  # the solver draws nothing at random
        known = _known(params, LOGISTIC_PARAMS, kind)
        penalty = known.get("penalty", "l2")
        mixes = {None: 0.0, "none": 0.0, "l2": 0.0, "l1": 1.0, "elasticnet": known.get("l1_ratio")}
        if mixes.get(penalty, -1) is None or penalty not in mixes:
            raise ValueError(f"penalty {penalty} needs a known name, and elasticnet an l1_ratio")
        solver = known.get("solver", "lbfgs" if penalty in SOLVERS["lbfgs"] else "saga")
        if solver not in SOLVERS:
            raise ValueError(f"solver {solver} solves another problem: it penalises the intercept or is unknown")
        if penalty not in SOLVERS[solver]:
            raise ValueError(f"solver {solver} does not take the penalty {penalty}")
        return LogisticRegression(
            labelCol=label,
            featuresCol="features",
            regParam=0.0 if penalty in (None, "none") else 1.0 / (float(known.get("C", 1.0)) * rows),
            elasticNetParam=float(mixes[penalty]),
            standardization=False,
            maxIter=int(known.get("max_iter", 100)),
            tol=float(known.get("tol", 1e-6)),
            fitIntercept=bool(known.get("fit_intercept", True)),
        )
    if kind == "RandomForestClassifier":
        known = {FOREST_PARAMS[k]: v for k, v in _known(params, set(FOREST_PARAMS), kind).items()}
        if known.get("maxDepth") is None:
            known["maxDepth"] = 30
        if "featureSubsetStrategy" in known:
            known["featureSubsetStrategy"] = "all" if known["featureSubsetStrategy"] is None else str(known["featureSubsetStrategy"])
        if known.get("subsamplingRate", 1.0) is None:
            known.pop("subsamplingRate")
        return RandomForestClassifier(labelCol=label, featuresCol="features", **{"numTrees": 100, **known})
    raise ValueError(f"unknown model type: {kind}")


def train_risk_model(
    risks: DataFrame,
    kind: str = "LogisticRegression",
    params: dict | None = None,
    label: str = "composite_risk",
    features: list[str] | None = None,
    test_share: float = TEST_SHARE,
    seed: int = SEED,
    balance: bool = True,
    exclude_leaky: bool = False,
) -> Trained:
    """Stratified split, oversampling of the train rows only, fit, and metrics on untouched test rows.

    The split is stored once; training and scoring read it from there.
    """
    names = feature_names(risks, features, exclude_leaky)
    rows = stable(select_features(risks, label, names).fillna(0, subset=names))
    rows = stable(stratified_split(rows, "customer_id", label, test_share, seed))
    train = rows.where("split = 'train'").drop("split")
    if balance:
        train = oversample_minority(train, names, label, "customer_id", seed=seed)
    assembler = VectorAssembler(inputCols=names, outputCol="features")
    vectors = stable(assembler.transform(train).select("features", label))
    classifier = make_classifier(kind, vectors.count(), label, params)
    model = PipelineModel([assembler, classifier.fit(vectors)])
    scored = stable(model.transform(rows.where("split = 'test'")))
    return Trained(model, names, scored, evaluate(scored, label))


def cross_validated_predictions(
    rows: DataFrame,
    features: list[str],
    label: str,
    key: str = "customer_id",
    folds: int = FOLDS,
    seed: int = SEED,
    kind: str = "LogisticRegression",
    params: dict | None = None,
) -> DataFrame:
    """(fold, key, label, score, prediction) of every row, scored by a model that never saw its fold. Run it on train rows.

    Folded vectors are stored once and the sizes of all folds counted together.
    """
    folded = stratified_folds(rows.select(key, *features, label), key, label, folds, seed)
    vectors = stable(VectorAssembler(inputCols=features, outputCol="features").transform(folded).select(key, "features", label, "fold"))
    sizes = {r["fold"]: r["n"] for r in vectors.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())

    def score(fold: int) -> DataFrame:
        train = vectors.where(F.col("fold") != fold)
        model = make_classifier(kind, total - sizes.get(fold, 0), label, params).fit(train)
        held = scored_rows(model.transform(vectors.where(F.col("fold") == fold)), label, key)
        return held.select(F.lit(fold).alias("fold"), *held.columns)

    return stable(reduce(DataFrame.unionByName, in_parallel(rows.sparkSession, score, folds)))


def fold_scores(predictions: DataFrame, folds: int = FOLDS) -> DataFrame:
    """(fold, f1): F1 of class 1 per fold, 0.0 for a fold without a hit, all from one aggregation."""
    hit = (F.col("prediction") == 1) & (F.col("label") == 1)
    both = F.count_if(F.col("prediction") == 1) + F.count_if(F.col("label") == 1)
    found = predictions.groupBy("fold").agg((2 * F.count_if(hit) / F.when(both > 0, both)).alias("f1"))
    every = predictions.sparkSession.range(folds).select(F.col("id").cast("int").alias("fold"))
    return every.join(found, "fold", "left").select("fold", F.coalesce("f1", F.lit(0.0)).alias("f1"))


def cross_validated_f1(rows: DataFrame, features: list[str], label: str, folds: int = FOLDS, **params) -> DataFrame:
    """F1 of class 1 per fold; parameters as ``cross_validated_predictions``."""
    return fold_scores(cross_validated_predictions(rows, features, label, folds=folds, **params), folds)


def cross_validation_summary(scores: DataFrame) -> DataFrame:
    """Mean F1 and twice its population deviation."""
    return scores.agg(F.avg("f1").alias("mean_f1"), (F.stddev_pop("f1") * 2).alias("two_std"))


def predictions_sample(predictions: DataFrame, label: str, limit: int, key: str = "customer_id") -> DataFrame:
    """Actual and predicted class of the first ``limit`` rows in key order."""
    return (
        predictions.select(
            key, F.col(label).cast("int").alias("actual"), F.col("prediction").cast("int").alias("predicted")
        )
        .orderBy(key)
        .limit(limit)
    )
