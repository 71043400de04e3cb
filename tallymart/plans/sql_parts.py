"""Common table expressions of the SQL counterparts. They state the same feeds as ``sources.feeds``."""

END = "as_of AS (SELECT max(o_orderdate)::DATE AS d FROM orders)"

PLACES = """places AS (
  SELECT c_custkey, c_name, c_acctbal, c_mktsegment, n_name, r_name,
         DATE '1995-01-01' + (c_custkey % 365)::INT AS registered
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

CLIENTS = f"""{PLACES}, clients AS (
  SELECT c_custkey::VARCHAR AS client_id, c_name AS name, n_name AS city, c_mktsegment AS loyalty_level FROM places)"""

ODD_CLIENTS = f"""{CLIENTS}, odd_clients AS (
  SELECT client_id, CASE client_id::BIGINT % 7 WHEN 0 THEN '  ' || name WHEN 1 THEN name || ' ' WHEN 2 THEN ''
    WHEN 3 THEN NULL WHEN 4 THEN 'a "quoted", ' || name WHEN 5 THEN 'two' || chr(10) || 'lines\\' ELSE name END AS name,
    city, loyalty_level FROM clients)"""

SHOP = f"""{CLIENTS}, shop AS (
  SELECT o_orderkey::VARCHAR AS order_id, o_custkey::VARCHAR AS client_id, o_totalprice AS order_amount,
         strftime(o_orderdate, '%Y-%m-%d') AS order_date, n_name AS city, c_mktsegment AS loyalty_level
  FROM orders JOIN places ON o_custkey = c_custkey)"""

TX = """tx AS (
  SELECT o_orderkey::VARCHAR AS transaction_id, o_custkey::VARCHAR AS customer_id, o_totalprice AS tx_amount,
         o_orderdate::DATE AS tx_date
  FROM orders)"""

PEOPLE = f"""{PLACES}, people AS (
  SELECT c_custkey::VARCHAR AS customer_id, registered AS registration_date, r_name AS region FROM places),
known AS (SELECT * FROM people WHERE customer_id::BIGINT % 13 <> 0)"""

ACTIVITY = """activity AS (
  SELECT customer_id, count(*) AS tx_count, max(tx_date) AS last_tx_date,
         sum(tx_amount::DECIMAL(18,2))::DOUBLE / count(tx_amount) AS avg_tx_amount
  FROM tx GROUP BY customer_id)"""


def _raw_tx(rows: str = "") -> str:
    return f"""raw_tx AS (
  SELECT k || copy AS transaction_id, customer_id, tx_amount,
         CASE WHEN dated IS NOT NULL AND k::BIGINT % 97 = 0 THEN DATE '2000-01-15' ELSE dated END AS tx_date
  FROM (
    SELECT o_orderkey::VARCHAR AS k,
      unnest(CASE WHEN o_orderkey % 37 = 0 THEN ['', '-dup'] ELSE [''] END) AS copy,
      CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_orderkey % 59 = 0 THEN '  ' ELSE o_custkey::VARCHAR END AS customer_id,
      CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 43 = 0 THEN -o_totalprice
           WHEN o_orderkey % 47 = 0 THEN o_totalprice * 1000 ELSE o_totalprice END AS tx_amount,
      CASE WHEN o_orderkey % 61 = 0 THEN (SELECT d FROM as_of) + 30 WHEN o_orderkey % 67 = 0 THEN DATE '1990-01-01'
           WHEN o_orderkey % 71 = 0 THEN NULL ELSE o_orderdate::DATE END AS dated
    FROM orders {rows}))"""


RAW_TX = _raw_tx()

CLEAN_TX = """valid_tx AS (
  SELECT * FROM raw_tx
  WHERE customer_id IS NOT NULL AND tx_amount IS NOT NULL AND tx_date IS NOT NULL
    AND length(trim(customer_id)) > 0 AND tx_amount > 0 AND tx_amount <= 1000000
    AND tx_date BETWEEN (SELECT d FROM as_of) - 1825 AND (SELECT d FROM as_of)),
clean_tx AS (
  SELECT transaction_id, customer_id, tx_amount, tx_date FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id, tx_date, tx_amount ORDER BY transaction_id) AS rn FROM valid_tx)
  WHERE rn = 1)"""


def _raw_customers(rows: str = "people") -> str:
    return f"""raw_customers AS (
  SELECT customer_id, registered + shift AS registration_date, region
  FROM (
    SELECT customer_id,
      CASE WHEN customer_id::BIGINT % 23 = 0 THEN (SELECT d FROM as_of) + 1
           WHEN customer_id::BIGINT % 19 = 0 THEN DATE '1980-01-01' ELSE registration_date END AS registered,
      CASE WHEN customer_id::BIGINT % 31 = 0 THEN NULL WHEN customer_id::BIGINT % 29 = 0 THEN '  ' ELSE region END AS region,
      unnest(CASE WHEN customer_id::BIGINT % 17 = 0 THEN [0, 1] ELSE [0] END) AS shift
    FROM {rows}))"""


RAW_CUSTOMERS = _raw_customers()

CLEAN_CUSTOMERS = """valid_customers AS (
  SELECT * FROM raw_customers
  WHERE customer_id IS NOT NULL AND registration_date IS NOT NULL AND region IS NOT NULL
    AND length(trim(customer_id)) > 0 AND length(trim(region)) > 0
    AND registration_date BETWEEN (SELECT d FROM as_of) - 3650 AND (SELECT d FROM as_of)),
clean_customers AS (
  SELECT customer_id, registration_date, region FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY registration_date, region) AS rn FROM valid_customers)
  WHERE rn = 1)"""

CLEAN = f"{END}, {PEOPLE}, {RAW_TX}, {CLEAN_TX}, {RAW_CUSTOMERS}, {CLEAN_CUSTOMERS}"
PATCHY = ", ".join(
    [END, PEOPLE, _raw_tx("WHERE o_custkey % 11 <> 0"), CLEAN_TX, _raw_customers("known"), CLEAN_CUSTOMERS]
)

FEATURES = f"""{END}, {TX}, {PEOPLE}, per_customer AS (
  SELECT customer_id, max(tx_date) AS last_tx_date, min(tx_date) AS first_tx_date,
         sum(tx_amount::DECIMAL(18,2))::DOUBLE / count(tx_amount) AS avg_tx_amount,
         stddev_samp(tx_amount) AS std_tx_amount, count(*) AS total_tx_count,
         sum(tx_amount::DECIMAL(18,2))::DOUBLE AS total_tx_amount
  FROM tx GROUP BY customer_id),
features AS (
  SELECT p.*, (d - last_tx_date)::INT AS days_since_last_tx, (last_tx_date - first_tx_date)::INT AS customer_lifetime_days,
         CASE WHEN d - last_tx_date > 30 THEN 1 ELSE 0 END AS is_churned,
         total_tx_count / greatest(last_tx_date - first_tx_date, 1) AS tx_frequency,
         registration_date, region, d AS analysis_reference_date
  FROM per_customer p CROSS JOIN as_of LEFT JOIN known USING (customer_id))"""

BASE = f"""{END}, {TX}, base AS (
  SELECT customer_id, count(*) AS total_transactions, sum(tx_amount::DECIMAL(18,2))::DOUBLE AS total_spent,
         sum(tx_amount::DECIMAL(18,2))::DOUBLE / count(tx_amount) AS avg_transaction_amount,
         count(*) FILTER (WHERE tx_date > d - 90 AND tx_date <= d) AS transactions_last_90d,
         (any_value(d) - max(tx_date))::INT AS days_since_last_transaction
  FROM tx CROSS JOIN as_of GROUP BY customer_id)"""

RISK = f"""{BASE}, medians AS (
  SELECT median(days_since_last_transaction) AS md, median(total_spent) AS ms, median(transactions_last_90d) AS ma FROM base),
flags AS (
  SELECT base.*, CASE WHEN days_since_last_transaction > md THEN 1 ELSE 0 END AS days_risk,
         CASE WHEN total_spent < ms THEN 1 ELSE 0 END AS spending_risk,
         CASE WHEN transactions_last_90d < ma THEN 1 ELSE 0 END AS activity_risk
  FROM base CROSS JOIN medians),
risk AS (SELECT *, CASE WHEN days_risk + spending_risk + activity_risk >= 2 THEN 1 ELSE 0 END AS composite_risk FROM flags)"""

SCORED = f"""{RISK}, scored AS (
  SELECT customer_id, composite_risk AS label, days_since_last_transaction / 1000 AS score,
         CASE WHEN days_since_last_transaction > 200 THEN 1 ELSE 0 END AS prediction
  FROM risk)"""

SALES = """sales AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, p_type AS product,
         CASE WHEN l_orderkey % 10 = 0 THEN NULL WHEN l_orderkey % 20 = 1 THEN -l_extendedprice ELSE l_extendedprice END AS amount
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

DEMO = f"""{PLACES}, demo AS (
  SELECT o_custkey::VARCHAR AS customer_id, l_orderkey::VARCHAR AS order_id, l_extendedprice AS amount, r_name AS region,
         n_name AS city, o_orderdate::DATE AS date, c_mktsegment AS segment, (18 + o_custkey % 60)::INT AS customer_age,
         CASE WHEN o_custkey % 29 <> 0 THEN ['f', 'm'][o_custkey % 2 + 1] END AS customer_gender,
         CASE WHEN o_custkey % 13 = 0 THEN NULL WHEN o_custkey % 17 = 0 THEN ' ' ELSE o_custkey || '@example.com' END AS email,
         CASE WHEN l_orderkey % 31 <> 0 THEN md5(l_orderkey::VARCHAR) END AS session_id,
         registered AS registration_date,
         ['ads', 'organic', 'referral', 'social'][o_custkey % 4 + 1] AS acquisition_channel,
         l_quantity AS quantity, CASE WHEN l_discount > 0 THEN 1 ELSE 0 END AS is_discounted,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_returned,
         CASE WHEN l_orderkey % 97 = 0 THEN 1 ELSE 0 END AS is_fraud,
         ['desktop', 'mobile', 'tablet'][l_orderkey % 3 + 1] AS device_type,
         ['card', 'cash', 'credit', 'online'][l_orderkey % 4 + 1] AS payment_method,
         l_partkey::VARCHAR AS product_id, p_type AS product_category,
         (o_custkey * 37) % 1800 / 10.0::DOUBLE - 90.0::DOUBLE AS lat, (o_custkey * 91) % 3600 / 10.0::DOUBLE - 180.0::DOUBLE AS lon
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN places ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey)"""

SCORING = """scoring AS (
  SELECT c_custkey::INT AS customer_id, (c_custkey % 120)::DOUBLE AS age,
         CASE WHEN c_acctbal * 200 > 1000000 THEN 1000000 ELSE c_acctbal * 200 END AS income, c_mktsegment AS region
  FROM customer WHERE c_custkey % 120 BETWEEN 0 AND 100 AND c_acctbal * 200 >= 0)"""
