"""Quality of a binary classifier from scored rows.

Inputs: ``label`` (0/1), ``score`` (higher means class 1) and ``prediction`` (0/1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.money import ratio
from tallymart.operators.ranks import running_totals
from tallymart.session import stable


def confusion(scored: DataFrame) -> DataFrame:
    return scored.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("count"))


def class_report(scored: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    Everything after ``confusion`` works on a few rows. A share with an empty base is 0.
    """

    def share(part, whole):
        return F.coalesce(ratio(part, whole), F.lit(0.0))

    cells = confusion(scored)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(
            F.col("label").cast("int").alias("class"),
            F.col("count").alias("support"),
            zero.alias("predicted"),
            hit.alias("hits"),
        ),
        F.struct(
            F.col("prediction").cast("int").alias("class"),
            zero.alias("support"),
            F.col("count").alias("predicted"),
            zero.alias("hits"),
        ),
    )
    classes = (
        cells.select(F.inline(sides))
        .groupBy("class")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits"))
        .withColumn("precision", share(F.col("hits"), F.col("predicted")))
        .withColumn("recall", share(F.col("hits"), F.col("support")))
        .withColumn("f1", share(F.col("hits") * 2, F.col("predicted") + F.col("support")))
    )
    measures = ["precision", "recall", "f1"]
    accuracy = share(F.sum("hits"), F.sum("support"))
    averages = classes.agg(
        F.array(
            F.struct(
                F.lit("accuracy").alias("class"),
                *[accuracy.alias(m) for m in measures],
                F.sum("support").alias("support"),
            ),
            F.struct(
                F.lit("macro avg").alias("class"),
                *[F.avg(m).alias(m) for m in measures],
                F.sum("support").alias("support"),
            ),
            F.struct(
                F.lit("weighted avg").alias("class"),
                *[share(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m) for m in measures],
                F.sum("support").alias("support"),
            ),
        ).alias("_rows")
    ).select(F.inline("_rows"))
    return classes.select(F.col("class").cast("string").alias("class"), *measures, "support").unionByName(averages)


def _by_score(scored: DataFrame) -> DataFrame:
    """Rows of each class per distinct score, stored: scored rows are read once."""
    return stable(
        scored.groupBy("score").agg(
            F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
        )
    )


def roc_points(scored: DataFrame) -> DataFrame:
    """One point per distinct score, from the origin (NULL threshold) to (1, 1)."""
    by_score = _by_score(scored)
    totals = by_score.agg(F.struct(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))).scalar()
    points = running_totals(by_score, "score", ["pos", "neg"], descending=True).select(
        F.col("score").alias("threshold"),
        ratio(F.col("cum_neg"), totals["neg"]).alias("fpr"),
        ratio(F.col("cum_pos"), totals["pos"]).alias("tpr"),
    )
    origin = by_score.limit(1).select(
        F.lit(None).cast(points.schema["threshold"].dataType).alias("threshold"),
        F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
    )
    return origin.unionByName(points)


def auc(scored: DataFrame) -> DataFrame:
    """Area under the ROC curve: pairs ranked rightly plus half of the ties, over all pairs."""
    steps = running_totals(_by_score(scored), "score", ["pos", "neg"], descending=True)
    won = F.col("neg").cast("double") * (F.col("cum_pos") - F.col("pos") / 2.0)
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return steps.agg(F.try_divide(F.sum(won), pairs).alias("auc"))


def classification_metrics(scored: DataFrame) -> DataFrame:
    """One row: accuracy, F1 of class 1 and class-weighted F1."""
    report = class_report(scored)
    return report.agg(
        F.max(F.when(F.col("class") == "accuracy", F.col("f1"))).alias("accuracy"),
        F.coalesce(F.max(F.when(F.col("class") == "1", F.col("f1"))), F.lit(0.0)).alias("f1_binary"),
        F.max(F.when(F.col("class") == "weighted avg", F.col("f1"))).alias("f1_weighted"),
    )
