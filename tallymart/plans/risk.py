"""Customer base, risk label, scaled features, segments, anomalies and oversampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.operators import anomalies, churn, oversampling, risk, scaling, segments, splits
from tallymart.plans import sql_parts as q
from tallymart.plans.registry import query, rounded
from tallymart.plans.sales import features
from tallymart.session import stable
from tallymart.sources import feeds


def base(t):
    return risk.customer_base(feeds.transactions(t), feeds.last_order_day(t))


def risks(t):
    return risk.composite_risk(base(t))


@query(f"WITH {q.BASE} SELECT * FROM base")
def customer_base(t):
    return base(t)


@query(f"WITH {q.RISK} SELECT round(md, 6) AS days_median, round(ms, 6) AS spent_median, ma AS activity_median FROM medians")
def median_thresholds(t):
    return rounded(risk.median_thresholds(stable(base(t))), 6, "days_median", "spent_median")


@query(f"WITH {q.RISK} SELECT * FROM risk")
def composite_risk(t):
    return risks(t)


@query(
    f"""WITH {q.RISK} SELECT composite_risk, count(*) AS "count",
  round(count(*) / (SELECT count(*) FROM risk) * 100, 6) AS percentage FROM risk GROUP BY composite_risk"""
)
def risk_distribution(t):
    return rounded(churn.class_distribution(risks(t), "composite_risk"), 6, "percentage")


@query(
    f"""WITH {q.RISK} SELECT customer_id, total_spent, days_since_last_transaction, transactions_last_90d,
  total_transactions, avg_transaction_amount, composite_risk FROM risk"""
)
def risk_features(t):
    return risk.select_features(risks(t))


@query(
    f"""WITH {q.RISK}, {q.PLACES} SELECT n_name AS nation, count(*) AS customers, sum(composite_risk)::BIGINT AS at_risk,
  sum(total_spent::DECIMAL(18,2))::DOUBLE AS total_spent, sum(composite_risk) / count(*) AS risk_share
FROM risk JOIN places ON customer_id = c_custkey::VARCHAR GROUP BY n_name"""
)
def risk_by_nation(t):
    places = feeds.clients(t).select(F.col("client_id").alias("customer_id"), F.col("city").alias("nation"))
    return risk.risk_by_group(risks(t), places, "nation")


@query(f"WITH {q.SCORING} SELECT * FROM scoring")
def scoring_rows(t):
    return scaling.capped_income(scaling.valid_scoring_rows(feeds.scoring_customers(t)))


_SCALED = f"""{q.SCORING}, stats AS (
  SELECT avg(age) AS ma, avg(income) AS mi, stddev_samp(age) AS sa, stddev_samp(income) AS si,
         stddev_pop(age) AS pa, stddev_pop(income) AS pi FROM scoring),
scaled AS (
  SELECT customer_id, (age - ma) / sa AS age_scaled, (income - mi) / si AS income_scaled,
         (age - ma) / pa AS age_pop, (income - mi) / pi AS income_pop FROM scoring, stats)"""


@query(
    f"""WITH {_SCALED} SELECT customer_id, round(age_scaled, 9) AS age_scaled, round(income_scaled, 9) AS income_scaled
FROM scaled"""
)
def scaled_features(t):
    vectors = scaling.scaled_scoring_features(feeds.scoring_customers(t))
    names = ["age_scaled", "income_scaled"]
    rows = scaling.vector_columns(vectors, "scaled_features", names).select("customer_id", *names)
    return rounded(rows, 9, *names)


@query(f"WITH {_SCALED} SELECT customer_id, round(age_pop, 9) AS age_pop, round(income_pop, 9) AS income_pop FROM scaled")
def population_scaled_features(t):
    rows = scoring_rows(t).select("customer_id", "age", "income")
    scaled = scaling.standardise_columns(rows, ["age", "income"], population=True, suffix="_pop")
    return rounded(scaled.select("customer_id", "age_pop", "income_pop"), 9, "age_pop", "income_pop")


@query(
    f"""WITH {_SCALED} SELECT customer_id, round(age_scaled / sqrt(age_scaled ** 2 + income_scaled ** 2), 9) AS age_unit,
  round(income_scaled / sqrt(age_scaled ** 2 + income_scaled ** 2), 9) AS income_unit FROM scaled"""
)
def normalized_features(t):
    vectors = scaling.scaled_scoring_features(feeds.scoring_customers(t))
    names = ["age_unit", "income_unit"]
    rows = scaling.vector_columns(vectors, "normalized_features", names).select("customer_id", *names)
    return rounded(rows, 9, *names)


@query(
    f"""WITH {q.PEOPLE}, ranked AS (
  SELECT region, (row_number() OVER (ORDER BY count(*) DESC, region) - 1)::DOUBLE AS region_index FROM people GROUP BY region)
SELECT customer_id, region, region_index FROM people JOIN ranked USING (region)"""
)
def region_index(t):
    indexed = scaling.index_categories(feeds.customers(t), "region")
    return indexed.select("customer_id", "region", "region_index")


@query(
    f"""WITH {q.FEATURES}, split AS (
  SELECT *, md5(customer_id || '|42') < 'cccccccd' AS train FROM features),
ranked AS (
  SELECT region, (row_number() OVER (ORDER BY count(*) DESC, region) - 1)::DOUBLE AS i
  FROM split WHERE train AND region IS NOT NULL GROUP BY region)
SELECT customer_id, avg_tx_amount, total_tx_count::DOUBLE AS total_tx_count, days_since_last_tx::DOUBLE AS days_since_last_tx,
  customer_lifetime_days::DOUBLE AS customer_lifetime_days, tx_frequency, round(coalesce(std_tx_amount, 0.0), 4)::DOUBLE AS std_tx_amount,
  (std_tx_amount IS NULL)::INT::DOUBLE AS std_missing, coalesce(i, (SELECT count(*) FROM ranked)::DOUBLE) AS region_index
FROM split LEFT JOIN ranked USING (region) WHERE NOT train"""
)
def churn_vectors(t):
    rows = splits.hash_split(churn.model_rows(features(t)), "customer_id")
    vectors, names = scaling.churn_vectors(rows.where("split = 'train'"), rows.where("split = 'test'"))
    entries = scaling.vector_columns(vectors.select("customer_id", "features"), "features", names)
    return rounded(entries.drop("features"), 4, "std_tx_amount")


_SEGMENT_MEASURES = ", ".join(
    f"round_even(avg({m}), 2) AS {m}_mean, round_even(stddev_samp({m}), 2) AS {m}_std"
    for m in ("total_transactions", "total_spent", "days_since_last_transaction", "transactions_last_90d")
)


@query(
    f"""WITH {q.BASE} SELECT c_mktsegment AS cluster, {_SEGMENT_MEASURES}, count(customer_id) AS customer_count
FROM base JOIN customer ON customer_id = c_custkey::VARCHAR GROUP BY c_mktsegment"""
)
def market_segment_profile(t):
    segment = t.customer.select(
        F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_mktsegment").alias("cluster")
    )
    return segments.segment_profile(base(t).join(segment, "customer_id"))


@query()
def customer_segments(t):
    return segments.customer_segments(base(t))


@query()
def segment_profile(t):
    return segments.segment_profile(segments.customer_segments(base(t)))


@query(
    f"""WITH {q.RISK} SELECT days_risk AS is_anomaly, round(avg(total_transactions), 6) AS total_transactions,
  round(avg(total_spent), 4) AS total_spent, round(avg(days_since_last_transaction), 6) AS days_since_last_transaction,
  count(customer_id) AS "count" FROM risk GROUP BY days_risk"""
)
def flagged_profile(t):
    flagged = risks(t).withColumnRenamed("days_risk", "is_anomaly")
    profile = segments.anomaly_profile(flagged)
    return rounded(rounded(profile, 6, "total_transactions", "days_since_last_transaction"), 4, "total_spent")


@query()
def anomaly_profile(t):
    return segments.anomaly_profile(anomalies.detect_anomalies(base(t)))


@query(
    f"""WITH {q.BASE}, n AS (SELECT count(*) AS n FROM base), flagged AS (
  SELECT (n - 1 - floor((1.0 - 0.1::DOUBLE) * (n - 1)))::BIGINT AS k, n FROM n)
SELECT 1 AS is_anomaly, k AS "count" FROM flagged UNION ALL SELECT 0, n - k FROM flagged"""
)
def anomaly_counts(t):
    flagged = anomalies.detect_anomalies(base(t))
    return flagged.groupBy("is_anomaly").agg(F.count(F.lit(1)).alias("count"))


@query(
    f"""WITH {q.RISK}, sizes AS (SELECT composite_risk, count(*) AS n FROM risk GROUP BY composite_risk)
SELECT composite_risk, 0 AS is_synthetic, n AS "count" FROM sizes
UNION ALL SELECT composite_risk, 1, (SELECT max(n) FROM sizes) - n FROM sizes WHERE n < (SELECT max(n) FROM sizes)"""
)
def smote_counts(t):
    made = oversampling.oversample_minority(risks(t), risk.RISK_FEATURES, "composite_risk", "customer_id")
    return made.groupBy("composite_risk", "is_synthetic").agg(F.count(F.lit(1)).alias("count"))


@query(
    f"""WITH {q.BASE}, keyed AS (SELECT (customer_id::BIGINT % 10)::VARCHAR AS k, (customer_id::BIGINT % 4 = 0)::INT AS y FROM base),
sizes AS (SELECT y, count(*) AS n FROM keyed GROUP BY y)
SELECT y, 0 AS is_synthetic, n AS "count" FROM sizes
UNION ALL SELECT y, 1, (SELECT max(n) FROM sizes) - n FROM sizes WHERE n < (SELECT max(n) FROM sizes)"""
)
def smote_repeated_keys(t):
    """Classes are raised to one size although ten keys stand for all rows."""
    number = F.col("customer_id").cast("bigint")
    rows = base(t).withColumns({"k": (number % 10).cast("string"), "y": (number % 4 == 0).cast("int")})
    made = oversampling.oversample_minority(rows, ["total_spent", "total_transactions"], "y", "k")
    return made.groupBy("y", "is_synthetic").agg(F.count(F.lit(1)).alias("count"))
