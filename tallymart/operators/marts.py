"""Sales and customer marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.money import money, money_avg, money_sum, ratio
from tallymart.operators.joins import client_columns


def sales_kpis(orders: DataFrame, clients: DataFrame, by: str) -> DataFrame:
    """Orders, revenue and mean order value of the orders of known clients, largest revenue first.

    ``by`` is a column of the order (``city``) or of the client (``client_loyalty``). Orders are
    totalled per client before the join, so a client with a third of all orders joins as one row.
    """
    clients = client_columns(clients)
    order_keys = [by] if by in orders.columns else []
    client_keys = [by] if by not in orders.columns else []
    per_client = orders.groupBy("client_id", *order_keys).agg(
        F.count("order_id").alias("_orders"),
        F.count("order_amount").alias("_amounts"),
        F.sum(money("order_amount")).alias("_revenue"),
    )
    return (
        per_client.join(clients.select("client_id", *client_keys), "client_id")
        .groupBy(by)
        .agg(
            F.sum("_orders").alias("total_orders"),
            F.sum("_revenue").cast("double").alias("total_revenue"),
            ratio(F.sum("_revenue"), F.sum("_amounts")).alias("avg_order_value"),
        )
        .orderBy(F.desc("total_revenue"), by)
    )


def customer_activity(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("tx_count"),
        F.max("tx_date").alias("last_tx_date"),
        money_avg("tx_amount").alias("avg_tx_amount"),
    )


def regional_activity(customers: DataFrame, activity: DataFrame) -> DataFrame:
    """Activity per region, most customers first. The amount is the plain mean of customer means."""
    return (
        customers.select("customer_id", "region")
        .join(activity, "customer_id")
        .groupBy("region")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.avg("tx_count").alias("avg_transactions_per_customer"),
            F.sum("tx_count").alias("total_transactions"),
            F.avg("avg_tx_amount").alias("avg_tx_amount"),
        )
        .orderBy(F.desc("customer_count"), "region")
    )


def transaction_statistics(transactions: DataFrame, limit: int | None = None) -> DataFrame:
    """Statistics of every customer; with ``limit``, of the first customers in key order."""
    rows = transactions.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("tx_count"),
        money_avg("tx_amount").alias("avg_amount"),
        money_sum("tx_amount").alias("total_amount"),
        F.min("tx_date").alias("first_transaction"),
        F.max("tx_date").alias("last_transaction"),
    )
    return rows if limit is None else rows.orderBy("customer_id").limit(limit)


def overview(transactions: DataFrame) -> DataFrame:
    """Rows, customers and date span of the transactions, in one row."""
    return transactions.agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count_distinct("customer_id").alias("customers"),
        F.min("tx_date").alias("first_tx_date"),
        F.max("tx_date").alias("last_tx_date"),
    )
