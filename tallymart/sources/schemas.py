"""The declared schemas of the input tables."""

ORDERS = (
    "order_id string, client_id string, order_amount double, order_date string, city string, loyalty_level string"
)
CLIENTS = "client_id string, name string, city string, loyalty_level string"
SALES = "id int not null, product string, amount double"
TRANSACTIONS = "transaction_id string, customer_id string, tx_amount double, tx_date date"
CHURN_TRANSACTIONS = "customer_id string, tx_amount double, tx_date date"
CUSTOMERS = "customer_id string, registration_date date, region string"
SCORING_CUSTOMERS = "customer_id int, age double, income double, region string"
