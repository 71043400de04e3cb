"""Sales, customer and churn marts."""

from __future__ import annotations

from tallymart.operators import churn, joins, marts
from tallymart.plans import sql_parts as q
from tallymart.plans.registry import query, rounded
from tallymart.sources import feeds

_KPIS = """count(order_id) AS total_orders, sum(order_amount::DECIMAL(18,2))::DOUBLE AS total_revenue,
  sum(order_amount::DECIMAL(18,2))::DOUBLE / count(order_amount) AS avg_order_value"""


@query(f"WITH {q.SHOP} SELECT s.city, {_KPIS} FROM shop s JOIN clients c USING (client_id) GROUP BY s.city")
def sales_by_city(t):
    return marts.sales_kpis(feeds.shop_orders(t), feeds.client_tiers(t), "city")


@query(
    f"""WITH {q.SHOP} SELECT c.loyalty_level AS client_loyalty, {_KPIS}
FROM shop s JOIN clients c USING (client_id) GROUP BY c.loyalty_level"""
)
def sales_by_loyalty(t):
    return marts.sales_kpis(feeds.order_totals(t), feeds.client_tiers(t), "client_loyalty")


@query(
    f"""WITH {q.SHOP} SELECT s.*, c.name, c.city AS client_city, c.loyalty_level AS client_loyalty
FROM shop s JOIN clients c USING (client_id)"""
)
def orders_with_clients(t):
    return joins.join_detail(feeds.shop_orders(t), joins.client_columns(feeds.clients(t)), "client_id")


@query(f"WITH {q.TX}, {q.ACTIVITY} SELECT * FROM activity")
def customer_activity(t):
    return marts.customer_activity(feeds.transactions(t))


_FLAGGED = f"""{q.TX}, {q.ACTIVITY}, flagged AS (
  SELECT *, CASE WHEN last_tx_date < (SELECT max(last_tx_date) FROM activity) - 30 THEN 1 ELSE 0 END AS is_churned
  FROM activity)"""


@query(f"WITH {_FLAGGED} SELECT * FROM flagged")
def activity_churn(t):
    return churn.activity_churn(marts.customer_activity(feeds.transactions(t)), feeds.last_order_day(t))


@query(
    f"""WITH {_FLAGGED} SELECT is_churned, count(*) AS customer_count, round(avg(tx_count), 6) AS avg_transactions,
  round(avg(avg_tx_amount), 6) AS avg_amount FROM flagged GROUP BY is_churned"""
)
def activity_churn_summary(t):
    return rounded(churn.activity_churn_summary(activity_churn(t)), 6, "avg_transactions", "avg_amount")


@query(
    f"""WITH {q.TX}, {q.ACTIVITY}, {q.PEOPLE} SELECT region, count(*) AS customer_count,
  round(avg(tx_count), 6) AS avg_transactions_per_customer, sum(tx_count)::BIGINT AS total_transactions,
  round(avg(avg_tx_amount), 6) AS avg_tx_amount
FROM people JOIN activity USING (customer_id) GROUP BY region"""
)
def regional_activity(t):
    activity = marts.customer_activity(feeds.transactions(t))
    mart = marts.regional_activity(feeds.customers(t), activity)
    return rounded(mart, 6, "avg_transactions_per_customer", "avg_tx_amount")


def features(t):
    return churn.churn_features(feeds.transactions(t), feeds.known_customers(t), feeds.last_order_day(t))


@query(
    f"""WITH {q.FEATURES} SELECT * REPLACE (round(std_tx_amount, 4) AS std_tx_amount)
FROM features"""
)
def churn_features(t):
    return rounded(features(t), 4, "std_tx_amount")


@query(
    f"""WITH {q.FEATURES} SELECT region, count(*) AS total_customers, round(avg(avg_tx_amount), 6) AS avg_region_tx_amount,
  round(avg(days_since_last_tx), 6) AS avg_days_since_last_tx, sum(is_churned)::BIGINT AS churned_customers,
  round(sum(is_churned) / count(*) * 100, 6) AS churn_rate_percent FROM features GROUP BY region"""
)
def churn_by_region(t):
    mart = churn.regional_churn(features(t))
    return rounded(mart, 6, "avg_region_tx_amount", "avg_days_since_last_tx", "churn_rate_percent")


@query(
    f"""WITH {q.FEATURES} SELECT is_churned, count(*) AS "count",
  round(count(*) / (SELECT count(*) FROM features) * 100, 6) AS percentage FROM features GROUP BY is_churned"""
)
def churn_distribution(t):
    return rounded(churn.class_distribution(features(t), "is_churned"), 6, "percentage")


@query(f'WITH {q.FEATURES} SELECT region, is_churned, count(*) AS "count" FROM features GROUP BY region, is_churned')
def region_churn_counts(t):
    return churn.region_churn_counts(features(t))


@query(
    f"""WITH {q.FEATURES} SELECT sum(is_churned)::BIGINT AS churned_customers, count(*) AS total_customers,
  sum(is_churned) / count(*) AS churn_rate FROM features"""
)
def churn_totals(t):
    return churn.churn_totals(features(t))


@query(
    f"""WITH {q.FEATURES} SELECT customer_id, is_churned, avg_tx_amount, total_tx_count, days_since_last_tx, region
FROM features ORDER BY customer_id LIMIT 1000"""
)
def feature_sample(t):
    return churn.feature_sample(features(t), limit=1000)


@query(
    f"""WITH {q.FEATURES} SELECT customer_id, is_churned FROM features WHERE avg_tx_amount IS NOT NULL
  AND total_tx_count IS NOT NULL AND days_since_last_tx IS NOT NULL AND customer_lifetime_days IS NOT NULL"""
)
def model_rows(t):
    return churn.model_rows(features(t)).select("customer_id", "is_churned")


@query(
    f"""WITH {q.TX} SELECT customer_id, count(*) AS tx_count,
  sum(tx_amount::DECIMAL(18,2))::DOUBLE / count(tx_amount) AS avg_amount,
  sum(tx_amount::DECIMAL(18,2))::DOUBLE AS total_amount, min(tx_date) AS first_transaction, max(tx_date) AS last_transaction
FROM tx GROUP BY customer_id"""
)
def tx_stats(t):
    return marts.transaction_statistics(feeds.transactions(t))


@query(
    f"""WITH {q.TX} SELECT count(*) AS transactions, count(DISTINCT customer_id) AS customers,
  min(tx_date) AS first_tx_date, max(tx_date) AS last_tx_date FROM tx"""
)
def transaction_overview(t):
    return marts.overview(feeds.transactions(t))
