"""Cleaning, its statistics and the quality report."""

from __future__ import annotations

from tallymart.operators import cleaning, joins
from tallymart.plans import sql_parts as q
from tallymart.plans.registry import query, rounded
from tallymart.session import scratch_path, stable
from tallymart.sources import feeds


def clean_tx(t):
    return cleaning.clean_transactions(feeds.raw_transactions(t), feeds.last_order_day(t))


def clean_profiles(t):
    return cleaning.clean_customers(feeds.raw_customers(t), feeds.last_order_day(t))


def patchy_tx(t):
    return cleaning.clean_transactions(feeds.patchy_transactions(t), feeds.last_order_day(t))


def patchy_profiles(t):
    return cleaning.clean_customers(feeds.patchy_customers(t), feeds.last_order_day(t))


@query(f"WITH {q.CLEAN} SELECT * FROM clean_tx")
def clean_transactions(t):
    return clean_tx(t)


@query(f"WITH {q.CLEAN} SELECT * FROM clean_customers")
def clean_customers(t):
    return clean_profiles(t)


def _statistics(raw: str, clean: str, rules: list[tuple[str, str]]) -> str:
    verdict = " ".join(f"WHEN NOT coalesce({ok}, false) THEN '{name}'" for name, ok in rules)
    removed = ", ".join(
        f"count(*) FILTER (WHERE verdict = '{name}') AS removed_{name}" for name, _ in rules
    )
    return f"""WITH {q.CLEAN}, verdicts AS (SELECT CASE {verdict} END AS verdict FROM {raw}),
after_cleaning AS (SELECT count(*) AS n FROM {clean})
SELECT count(*) AS original_count, {removed},
  count(*) FILTER (WHERE verdict IS NULL) - (SELECT n FROM after_cleaning) AS removed_duplicate,
  (SELECT n FROM after_cleaning) AS cleaned_count, count(*) - (SELECT n FROM after_cleaning) AS removed_count,
  round((count(*) - (SELECT n FROM after_cleaning)) * 100.0::DOUBLE / count(*), 2) AS removed_percent
FROM verdicts"""


_TX_STATISTICS = _statistics(
    "raw_tx",
    "clean_tx",
    [
        ("missing_value", "customer_id IS NOT NULL AND tx_amount IS NOT NULL AND tx_date IS NOT NULL"),
        ("blank_customer", "length(trim(customer_id)) > 0"),
        ("amount_not_positive", "tx_amount > 0"),
        ("amount_over_cap", "tx_amount <= 1000000"),
        ("date_out_of_window", "tx_date BETWEEN (SELECT d FROM as_of) - 1825 AND (SELECT d FROM as_of)"),
    ],
)


@query(_TX_STATISTICS)
def transaction_cleaning_stats(t):
    rules = cleaning.transaction_rules(feeds.last_order_day(t))
    return cleaning.cleaning_statistics(feeds.raw_transactions(t), rules, cleaning.TRANSACTION_KEYS)


_CUSTOMER_STATISTICS = _statistics(
    "raw_customers",
    "clean_customers",
    [
        ("missing_value", "customer_id IS NOT NULL AND registration_date IS NOT NULL AND region IS NOT NULL"),
        ("blank_customer", "length(trim(customer_id)) > 0"),
        ("blank_region", "length(trim(region)) > 0"),
        ("date_out_of_window", "registration_date BETWEEN (SELECT d FROM as_of) - 3650 AND (SELECT d FROM as_of)"),
    ],
)


@query(_CUSTOMER_STATISTICS)
def customer_cleaning_stats(t):
    rules = cleaning.customer_rules(feeds.last_order_day(t))
    return cleaning.cleaning_statistics(feeds.raw_customers(t), rules, cleaning.CUSTOMER_KEYS)


@query(
    f"""WITH {q.CLEAN} SELECT sum(tx_amount::DECIMAL(18,2))::DOUBLE / count(tx_amount) AS avg_amount,
  round(stddev_samp(tx_amount), 4) AS std_amount, min(tx_amount) AS min_amount, max(tx_amount) AS max_amount FROM clean_tx"""
)
def amount_profile(t):
    return rounded(cleaning.amount_profile(clean_tx(t)), 4, "std_amount")


def _written_tx(t):
    rules = cleaning.transaction_rules(feeds.last_order_day(t))
    path = scratch_path(t.spark, "clean-transactions")
    return cleaning.clean_and_count(
        feeds.raw_transactions(t), rules, cleaning.TRANSACTION_KEYS, ["transaction_id"], path, cleaning.amount_aggregates()
    )


_AMOUNTS = """SELECT sum(tx_amount::DECIMAL(18,2))::DOUBLE / count(tx_amount) AS avg_amount,
  round(stddev_samp(tx_amount), 4) AS std_amount, min(tx_amount) AS min_amount, max(tx_amount) AS max_amount FROM clean_tx"""


@query(_TX_STATISTICS.replace("FROM verdicts", f", a.* FROM verdicts, ({_AMOUNTS}) a GROUP BY ALL"))
def written_transaction_statistics(t):
    """Statistics and amounts from the one table that cleaning wrote."""
    return rounded(_written_tx(t)[1], 4, "std_amount")


@query(f"WITH {q.CLEAN} SELECT * FROM clean_tx")
def written_transactions(t):
    """The rows of the same write."""
    return _written_tx(t)[0]


@query(_CUSTOMER_STATISTICS)
def written_customer_statistics(t):
    rules = cleaning.customer_rules(feeds.last_order_day(t))
    order = ["registration_date", "region"]
    path = scratch_path(t.spark, "clean-customers")
    return cleaning.clean_and_count(feeds.raw_customers(t), rules, cleaning.CUSTOMER_KEYS, order, path)[1]


@query(f'WITH {q.CLEAN} SELECT region, count(*) AS "count" FROM clean_customers GROUP BY region')
def region_frequency(t):
    return cleaning.frequency(clean_profiles(t), "region")


@query(
    f"""WITH {q.CLEAN} SELECT tx_date, count(*) AS "count" FROM clean_tx GROUP BY tx_date
ORDER BY count(*) DESC, tx_date LIMIT 10"""
)
def busiest_days(t):
    return cleaning.frequency(clean_tx(t), "tx_date", 10)


@query(
    f"""WITH {q.PATCHY}, days AS (SELECT tx_date, count(*) AS n FROM clean_tx GROUP BY tx_date),
top_days AS (SELECT * FROM days ORDER BY n DESC, tx_date LIMIT 10)
SELECT 'customers_without_transactions' AS "check", '' AS item,
  (SELECT count(DISTINCT customer_id) FROM clean_customers
   WHERE customer_id NOT IN (SELECT customer_id FROM clean_tx))::VARCHAR AS "value"
UNION ALL SELECT 'transactions_without_profile', '',
  (SELECT count(DISTINCT customer_id) FROM clean_tx
   WHERE customer_id NOT IN (SELECT customer_id FROM clean_customers))::VARCHAR
UNION ALL SELECT 'first_tx_date', '', min(tx_date)::VARCHAR FROM days
UNION ALL SELECT 'last_tx_date', '', max(tx_date)::VARCHAR FROM days
UNION ALL SELECT 'busiest_day', tx_date::VARCHAR, n::VARCHAR FROM top_days"""
)
def quality_report(t):
    """The cleaned tables are written first; the checks then read the columns they need."""
    return cleaning.quality_report(stable(patchy_tx(t)), stable(patchy_profiles(t)))


@query(
    f"""WITH {q.PATCHY} SELECT DISTINCT customer_id FROM clean_customers
WHERE customer_id NOT IN (SELECT customer_id FROM clean_tx)"""
)
def customers_without_transactions(t):
    return joins.keys_only_in(patchy_profiles(t), patchy_tx(t), "customer_id")


@query(
    f"""WITH {q.PATCHY} SELECT DISTINCT customer_id FROM clean_tx
WHERE customer_id NOT IN (SELECT customer_id FROM clean_customers)"""
)
def transactions_without_profile(t):
    return joins.keys_only_in(patchy_tx(t), patchy_profiles(t), "customer_id")


@query(f"WITH {q.CLEAN} SELECT DISTINCT customer_id FROM raw_tx")
def distinct_customers(t):
    return joins.distinct_keys(feeds.raw_transactions(t), "customer_id")
