"""Profiles of raw tables and of the flat order table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.operators import moments, profile, sketches
from tallymart.operators.counts import value_counts
from tallymart.plans import sql_parts as q
from tallymart.plans.cleaning import clean_tx
from tallymart.plans.registry import query, rounded
from tallymart.plans.sales import features
from tallymart.sources import feeds

_DESCRIBED = ["avg_tx_amount", "days_since_last_tx", "total_tx_count", "tx_frequency"]
_STATS = {"count": "count", "mean": "avg", "stddev": "stddev_samp", "min": "min", "max": "max"}


def _describe_sql(table: str, columns: list[str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{name}' AS stat, round({fn}({c})::DOUBLE, 6) AS \"value\" FROM {table}"
        for c in columns
        for name, fn in _STATS.items()
    )


@query(f"WITH {q.FEATURES} {_describe_sql('features', _DESCRIBED)}")
def describe_features(t):
    return rounded(profile.describe_columns(features(t), _DESCRIBED), 6, "value")


@query(f"WITH {q.TX} {_describe_sql('tx', ['tx_amount'])}")
def describe_amounts(t):
    return rounded(profile.describe_columns(feeds.transactions(t), ["tx_amount"]), 6, "value")


@query(
    f"""WITH {q.SALES} SELECT count(*) AS total_rows, count(*) FILTER (WHERE amount IS NULL) AS null_amounts,
  count(*) FILTER (WHERE amount < 0) AS negative_amounts,
  round(count(*) FILTER (WHERE amount IS NULL) * 100.0::DOUBLE / count(*), 2) AS null_percentage,
  round(count(*) FILTER (WHERE amount < 0) * 100.0::DOUBLE / count(*), 2) AS negative_percentage FROM sales"""
)
def sales_null_profile(t):
    return profile.null_and_negative(feeds.sales(t))


def _missing_sql(table: str, columns: dict[str, bool]) -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS "rows", count(*) FILTER (WHERE {gap}) AS missing,
  round(count(*) FILTER (WHERE {gap}) * 100.0::DOUBLE / count(*), 2) AS missing_percent FROM {table}"""
        for c, text in columns.items()
        for gap in [f"{c} IS NULL OR trim({c}) = ''" if text else f"{c} IS NULL"]
    )


@query(
    f"""WITH {q.END}, {q.RAW_TX} {_missing_sql(
        'raw_tx', {'transaction_id': True, 'customer_id': True, 'tx_amount': False, 'tx_date': False})}"""
)
def null_profile(t):
    return profile.missing_values(feeds.raw_transactions(t))


@query(
    f"""WITH {q.END}, {q.PEOPLE}, {q.RAW_CUSTOMERS} {_missing_sql(
        'raw_customers', {'customer_id': True, 'registration_date': False, 'region': True})}"""
)
def customer_null_profile(t):
    return profile.missing_values(feeds.raw_customers(t))


@query(
    f"""WITH {q.END}, {q.RAW_TX} SELECT customer_id, tx_date, tx_amount, count(*) AS copies FROM raw_tx
GROUP BY ALL HAVING count(*) > 1"""
)
def duplicate_orders(t):
    return profile.duplicate_groups(feeds.raw_transactions(t), ["customer_id", "tx_date", "tx_amount"])


_FENCE = f"""{q.END}, {q.RAW_TX}, quartiles AS (
  SELECT quantile_cont(tx_amount, 0.25) AS q1, quantile_cont(tx_amount, 0.75) AS q3 FROM raw_tx),
fence AS (SELECT q1, q3, q1 - (q3 - q1) * 1.5 AS low_fence, q3 + (q3 - q1) * 1.5 AS high_fence FROM quartiles)"""


@query(
    f"""WITH {_FENCE} SELECT round(q1, 6) AS q1, round(q3, 6) AS q3, round(low_fence, 6) AS low_fence,
  round(high_fence, 6) AS high_fence FROM fence"""
)
def amount_fence(t):
    return rounded(
        profile.outlier_fence(feeds.raw_transactions(t), "tx_amount"), 6, "q1", "q3", "low_fence", "high_fence"
    )


@query(f"WITH {_FENCE} SELECT raw_tx.* FROM raw_tx, fence WHERE tx_amount < low_fence OR tx_amount > high_fence")
def amount_outliers(t):
    return profile.outliers(feeds.raw_transactions(t), "tx_amount")


@query(
    f"""WITH {q.CLEAN}, days AS (SELECT tx_date AS "day", count(*) AS "rows" FROM clean_tx GROUP BY tx_date),
typical AS (SELECT median("rows") AS m FROM days),
spread AS (SELECT median(abs("rows" - m)) AS mad FROM days, typical)
SELECT "day", "rows", m AS median_rows, mad, m + mad * 1.4826::DOUBLE * 6 AS "limit" FROM days, typical, spread
WHERE "rows" > m + mad * 1.4826::DOUBLE * 6"""
)
def spike_days(t):
    return profile.spike_days(clean_tx(t), "tx_date")


@query(
    f"""WITH {q.TX} SELECT tx_date AS "day", count(*) AS orders, sum(tx_amount::DECIMAL(18,2))::DOUBLE AS revenue
FROM tx GROUP BY tx_date"""
)
def daily_series(t):
    return profile.daily_series(feeds.transactions(t), "tx_date", "tx_amount")


@query(
    """SELECT hour(ts)::INT AS "hour", count(*) AS orders, sum("value"::DECIMAL(18,2))::DOUBLE AS revenue
FROM events GROUP BY 1"""
)
def hourly_pattern(t):
    return profile.hourly_pattern(feeds.event_orders(t), "order_time", "amount")


@query(
    """SELECT (isodow(ts) - 1)::INT AS weekday, count(*) AS orders, sum("value"::DECIMAL(18,2))::DOUBLE AS revenue
FROM events GROUP BY 1"""
)
def weekday_pattern(t):
    return profile.weekday_pattern(feeds.event_orders(t), "order_time", "amount")


_DIMENSIONS = [
    "segment", "region", "city", "customer_gender", "acquisition_channel", "device_type", "payment_method", "product_category",
]


@query(
    f"WITH {q.DEMO} "
    + "\nUNION ALL ".join(
        f"""SELECT '{d}' AS dimension, {d} AS item, count(*) AS orders, sum(amount::DECIMAL(18,2))::DOUBLE AS revenue,
  sum(amount::DECIMAL(18,2))::DOUBLE / count(amount) AS avg_amount FROM demo GROUP BY {d}"""
        for d in _DIMENSIONS
    )
)
def breakdowns(t):
    return profile.breakdowns(feeds.demo_transactions(t, "amount", *_DIMENSIONS), _DIMENSIONS)


@query(
    f"""WITH {q.DEMO}, firsts AS (SELECT customer_id, min(date) AS first_date FROM demo GROUP BY customer_id)
SELECT date_trunc('month', date)::DATE AS "month", CASE WHEN date = first_date THEN 'new' ELSE 'returning' END AS customer_kind,
  count(*) AS orders, sum(amount::DECIMAL(18,2))::DOUBLE AS revenue
FROM demo JOIN firsts USING (customer_id) GROUP BY 1, 2"""
)
def new_vs_returning(t):
    return profile.new_and_returning(feeds.demo_transactions(t, "customer_id", "date", "amount"), "date")


@query(
    f"""WITH {q.DEMO} SELECT acquisition_channel, count(*) AS orders, sum(is_discounted) / count(*) AS is_discounted_rate,
  sum(is_returned) / count(*) AS is_returned_rate, sum(is_fraud) / count(*) AS is_fraud_rate
FROM demo GROUP BY acquisition_channel"""
)
def flag_rates(t):
    flags = ["is_discounted", "is_returned", "is_fraud"]
    return profile.flag_rates(feeds.demo_transactions(t, "acquisition_channel", *flags), "acquisition_channel", flags)


_FLAT = ["is_discounted", "is_returned", "customer_age", "quantity", "amount"]
_CORRELATED = [*_FLAT, *[f"channel_{n}" for n in feeds.CHANNELS]]
_CHANNEL_SQL = ", ".join(f"(acquisition_channel = '{n}')::INT AS channel_{n}" for n in feeds.CHANNELS)


@query(
    f"WITH {q.DEMO}, indicated AS (SELECT *, {_CHANNEL_SQL} FROM demo) "
    + "\nUNION ALL ".join(
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", round(corr({a}::DOUBLE, {b}::DOUBLE), 9) AS correlation FROM indicated"
        for i, a in enumerate(_CORRELATED)
        for b in _CORRELATED[i + 1 :]
    )
)
def correlations(t):
    rows = feeds.channel_indicators(feeds.demo_transactions(t, "acquisition_channel", *_FLAT))
    return rounded(moments.correlations(rows, _CORRELATED), 9, "correlation")


_PROFILED = ["amount", "quantity", "customer_age"]


@query(
    f"WITH {q.DEMO} "
    + "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", count(DISTINCT {c}) AS "distinct", min({c})::DOUBLE AS "min",
  max({c})::DOUBLE AS "max", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev,
  round(quantile_cont({c}, 0.25), 6)::DOUBLE AS q1, round(median({c}), 6)::DOUBLE AS median,
  round(quantile_cont({c}, 0.75), 6)::DOUBLE AS q3 FROM demo"""
        for c in _PROFILED
    )
)
def column_profile(t):
    profiled = profile.column_profile(feeds.demo_transactions(t, *_PROFILED), _PROFILED)
    return rounded(profiled, 6, "mean", "stddev", "q1", "median", "q3")


_SHARES = [0.01, 0.25, 0.5, 0.75, 0.99]


@query(
    f"WITH {q.DEMO} "
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {p}::DOUBLE AS probability, count({c}) AS n, true AS within FROM demo"
        for c in _PROFILED
        for p in _SHARES
    )
)
def sketched_quantiles(t):
    """Sketches of the regions' rows, merged: are their quantiles within three times the stated error of the exact ranks?"""
    rows = feeds.demo_transactions(t, "region", *_PROFILED)
    found = sketches.quantiles(sketches.merged(sketches.sketches(rows, _PROFILED, ["region"])), _SHARES)
    # Ranks of a value that occurs many times are a range, from the rows below it to those up to it.
    value, n = F.col("value"), F.col("n")
    counts = value_counts(rows, _PROFILED).withColumnsRenamed({"value": "held", "n": "held_n"})
    ranked = found.join(counts, "column").groupBy("column", "probability", "n").agg(
        F.sum(F.when(F.col("held") < value, F.col("held_n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("held") <= value, F.col("held_n")).otherwise(0)).alias("upto"),
    )
    slack, wanted = 3 * sketches.rank_error() * n + 1, F.col("probability") * n
    within = (F.col("below") <= wanted + slack) & (F.col("upto") >= wanted - slack)
    return ranked.select("column", "probability", "n", within.alias("within"))


@query(
    f"WITH {q.DEMO} "
    + "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", min({c})::DOUBLE AS "min", max({c})::DOUBLE AS "max",
  round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev, true AS ordered FROM demo"""
        for c in _PROFILED
    )
)
def sketched_profile(t):
    """The profile from sketches, in one pass; its quartiles are values in order."""
    rows = profile.column_profile(feeds.demo_transactions(t, *_PROFILED), _PROFILED, exact=False)
    ordered = (F.col("min") <= F.col("q1")) & (F.col("q1") <= F.col("median")) & (F.col("median") <= F.col("q3")) & (F.col("q3") <= F.col("max"))
    return rounded(rows, 6, "mean", "stddev").select("column", "count", "min", "max", "mean", "stddev", ordered.alias("ordered"))


@query(
    f"""WITH {q.DEMO} SELECT floor(lat / 10)::INT AS lat_cell, floor(lon / 10)::INT AS lon_cell, count(*) AS orders,
  count(DISTINCT customer_id) AS customers FROM demo GROUP BY 1, 2"""
)
def geo_grid(t):
    return profile.geo_grid(feeds.demo_transactions(t, "customer_id", "lat", "lon"), 10.0)


_GAPS = {"email": True, "session_id": True, "customer_gender": True, "city": True, "amount": False}


@query(f"WITH {q.DEMO} {_missing_sql('demo', _GAPS)}")
def order_table_gaps(t):
    return profile.missing_values(feeds.demo_transactions(t, *_GAPS))
