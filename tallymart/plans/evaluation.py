"""Splits and classifier quality, fed with a deterministic score."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.operators import evaluation, splits
from tallymart.plans import sql_parts as q
from tallymart.plans.registry import query, rounded
from tallymart.plans.risk import risks
from tallymart.session import stable
from tallymart.sources import feeds


def scored(t):
    """Recency as the score of the risk label."""
    days = F.col("days_since_last_transaction")
    return risks(t).select(
        "customer_id",
        F.col("composite_risk").alias("label"),
        (days / 1000).alias("score"),
        F.when(days > 200, 1).otherwise(0).alias("prediction"),
    )


@query(
    f"""WITH {q.TX} SELECT transaction_id,
  CASE WHEN md5(transaction_id || '|42') < 'cccccccd' THEN 'train' ELSE 'test' END AS split FROM tx"""
)
def hash_split(t):
    return splits.hash_split(feeds.transactions(t), "transaction_id").select("transaction_id", "split")


@query(
    f"""WITH {q.RISK}, ranked AS (
  SELECT customer_id, composite_risk, count(*) OVER (PARTITION BY composite_risk) AS n,
         row_number() OVER (PARTITION BY composite_risk ORDER BY md5(customer_id || '|42')) AS r FROM risk)
SELECT customer_id, composite_risk, CASE WHEN r <= round(0.3::DOUBLE * n) THEN 'test' ELSE 'train' END AS split FROM ranked"""
)
def stratified_split(t):
    rows = risks(t).select("customer_id", "composite_risk")
    return splits.stratified_split(rows, "customer_id", "composite_risk")


@query(
    f"""WITH {q.RISK}, ranked AS (
  SELECT customer_id, composite_risk, count(*) OVER (PARTITION BY composite_risk) AS n,
         row_number() OVER (PARTITION BY composite_risk ORDER BY md5(customer_id || '|42')) AS r FROM risk)
SELECT customer_id, composite_risk, ((r > n * 1 // 5)::INT + (r > n * 2 // 5)::INT + (r > n * 3 // 5)::INT
  + (r > n * 4 // 5)::INT)::INT AS fold FROM ranked"""
)
def stratified_folds(t):
    rows = risks(t).select("customer_id", "composite_risk")
    return splits.stratified_folds(rows, "customer_id", "composite_risk")


def _orders_by_customer(t):
    """Orders under the key of their customer, which repeats; large amounts are the class of interest."""
    rows = feeds.transactions(t)
    return rows.select("transaction_id", "customer_id", "tx_amount", (F.col("tx_amount") > 200_000).cast("int").alias("large"))


_LARGE = f"{q.TX}, large AS (SELECT customer_id, (tx_amount > 200000)::INT AS large FROM tx), sizes AS (SELECT large, count(*) AS n FROM large GROUP BY large)"


@query(
    f"""WITH {_LARGE}, cut AS (SELECT large, n, round(0.3::DOUBLE * n)::BIGINT AS test FROM sizes)
SELECT large, 'test' AS split, test AS "rows", true AS one_key_cut FROM cut
UNION ALL SELECT large, 'train', n - test, true FROM cut"""
)
def repeated_key_split(t):
    """Exact class counts although keys repeat; at most one key of a class is on both sides."""
    rows = stable(splits.stratified_split(_orders_by_customer(t), "customer_id", "large"))
    sides = rows.groupBy("large", "customer_id").agg(F.count_distinct("split").alias("sides"))
    cut = sides.groupBy("large").agg((F.count_if(F.col("sides") > 1) <= 1).alias("one_key_cut"))
    return rows.groupBy("large", "split").agg(F.count(F.lit(1)).alias("rows")).join(cut, "large")


@query(
    f"""WITH {_LARGE} SELECT large, i::INT AS fold, (n * (i + 1) // 5 - n * i // 5)::BIGINT AS "rows", true AS few_keys_cut
FROM sizes, range(5) r(i)"""
)
def repeated_key_folds(t):
    """Folds of a class differ by at most one row although keys repeat; at most four keys of a class are cut."""
    rows = stable(splits.stratified_folds(_orders_by_customer(t), "customer_id", "large"))
    spread = rows.groupBy("large", "customer_id").agg((F.count_distinct("fold") - 1).alias("cuts"))
    cut = spread.groupBy("large").agg((F.sum("cuts") <= 4).alias("few_keys_cut"))
    return rows.groupBy("large", "fold").agg(F.count(F.lit(1)).alias("rows")).join(cut, "large")


@query(f'WITH {q.SCORED} SELECT label, prediction, count(*) AS "count" FROM scored GROUP BY label, prediction')
def confusion(t):
    return evaluation.confusion(scored(t))


_CLASSES = f"""{q.SCORED}, classes AS (
  SELECT k, count(*) FILTER (WHERE label = k) AS support, count(*) FILTER (WHERE prediction = k) AS predicted,
         count(*) FILTER (WHERE label = k AND prediction = k) AS hits
  FROM scored, (SELECT unnest([0, 1]) AS k) GROUP BY k),
measured AS (
  SELECT k, coalesce(hits / nullif(predicted, 0), 0) AS "precision", coalesce(hits / nullif(support, 0), 0) AS recall,
         coalesce(2 * hits / nullif(predicted + support, 0), 0) AS f1, support, hits FROM classes)"""


@query(
    f"""WITH {_CLASSES}
SELECT k::VARCHAR AS "class", round("precision", 9) AS "precision", round(recall, 9) AS recall, round(f1, 9) AS f1, support
FROM measured
UNION ALL SELECT 'accuracy', round(sum(hits) / sum(support), 9), round(sum(hits) / sum(support), 9),
  round(sum(hits) / sum(support), 9), sum(support)::BIGINT FROM measured
UNION ALL SELECT 'macro avg', round(avg("precision"), 9), round(avg(recall), 9), round(avg(f1), 9), sum(support)::BIGINT
FROM measured
UNION ALL SELECT 'weighted avg', round(sum("precision" * support) / sum(support), 9),
  round(sum(recall * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9), sum(support)::BIGINT FROM measured"""
)
def class_report(t):
    return rounded(evaluation.class_report(scored(t)), 9, "precision", "recall", "f1")


@query(
    f"""WITH {_CLASSES} SELECT round(sum(hits) / sum(support), 9) AS accuracy,
  round(max(f1) FILTER (WHERE k = 1), 9) AS f1_binary, round(sum(f1 * support) / sum(support), 9) AS f1_weighted
FROM measured"""
)
def classification_metrics(t):
    return rounded(evaluation.classification_metrics(scored(t)), 9, "accuracy", "f1_binary", "f1_weighted")


_STEPS = f"""{q.SCORED}, by_score AS (
  SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM scored GROUP BY score),
steps AS (
  SELECT *, sum(pos) OVER (ORDER BY score DESC) AS cum_pos, sum(neg) OVER (ORDER BY score DESC) AS cum_neg FROM by_score)"""


@query(
    f"""WITH {_STEPS}
SELECT score AS threshold, cum_neg / (SELECT sum(neg) FROM steps) AS fpr, cum_pos / (SELECT sum(pos) FROM steps) AS tpr
FROM steps
UNION ALL SELECT NULL, 0.0::DOUBLE, 0.0::DOUBLE"""
)
def roc_points(t):
    return evaluation.roc_points(scored(t))


@query(
    f"""WITH {_STEPS} SELECT round(sum(neg * (cum_pos - pos / 2))::DOUBLE / (sum(pos) * sum(neg)), 9) AS auc FROM steps"""
)
def auc(t):
    return rounded(evaluation.auc(scored(t)), 9, "auc")
