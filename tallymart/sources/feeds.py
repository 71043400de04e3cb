"""Feeds of the operators, derived from the test tables, with defects planted by key arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPIKE_DAY = "2000-01-15"
CHANNELS = ["ads", "organic", "referral", "social"]


class Tables:
    """The parquet tables of one scale-factor folder, read lazily by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def last_order_day(t: Tables) -> Column:
    return t.orders.agg(F.max(F.col("o_orderdate").cast("date"))).scalar()


def customer_places(t: Tables) -> DataFrame:
    """Customers with the names of their nation and region (two small tables Spark broadcasts by size)."""
    nations = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    regions = t.region.select("r_regionkey", "r_name")
    return t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).join(
        regions, F.col("n_regionkey") == F.col("r_regionkey")
    )


def _registered() -> Column:
    return F.date_add(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int"))


def clients(t: Tables) -> DataFrame:
    return customer_places(t).select(
        F.col("c_custkey").cast("string").alias("client_id"),
        F.col("c_name").alias("name"),
        F.col("n_name").alias("city"),
        F.col("c_mktsegment").alias("loyalty_level"),
    )


def odd_clients(t: Tables) -> DataFrame:
    """Clients whose names try what a text file can hold."""
    kind = F.col("client_id").cast("bigint") % 7
    name = (
        F.when(kind == 0, F.concat(F.lit("  "), "name"))
        .when(kind == 1, F.concat("name", F.lit(" ")))
        .when(kind == 2, F.lit(""))
        .when(kind == 3, F.lit(None))
        .when(kind == 4, F.concat(F.lit('a "quoted", '), "name"))
        .when(kind == 5, F.lit("two\nlines\\"))
        .otherwise(F.col("name"))
    )
    return clients(t).withColumn("name", name)


def shop_orders(t: Tables) -> DataFrame:
    """Orders with the city and tier of the order itself."""
    places = customer_places(t).select("c_custkey", "n_name", "c_mktsegment")
    return t.orders.join(places, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("client_id"),
        F.col("o_totalprice").alias("order_amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.col("n_name").alias("city"),
        F.col("c_mktsegment").alias("loyalty_level"),
    )


def sales(t: Tables) -> DataFrame:
    """Line items as product sales; every tenth amount is missing, every twentieth negative."""
    key = F.col("l_orderkey")
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    parts = t.part.select("p_partkey", "p_type")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        (key * 10 + F.col("l_linenumber")).alias("id"),
        F.col("p_type").alias("product"),
        F.when(key % 10 == 0, F.lit(None))
        .when(key % 20 == 1, -F.col("l_extendedprice"))
        .otherwise(F.col("l_extendedprice"))
        .alias("amount"),
    )


def transactions(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_totalprice").alias("tx_amount"),
        F.col("o_orderdate").cast("date").alias("tx_date"),
    )


def customers(t: Tables) -> DataFrame:
    """All profiles, one row per customer."""
    return customer_places(t).select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        _registered().alias("registration_date"),
        F.col("r_name").alias("region"),
    )


def known_customers(t: Tables) -> DataFrame:
    """Profiles with one customer in 13 missing, so that outer joins have a NULL side."""
    return customers(t).where(F.col("customer_id").cast("bigint") % 13 != 0)


def raw_transactions(t: Tables) -> DataFrame:
    """Transactions with planted gaps, bad amounts, bad dates, a spike day and repeated rows."""
    return _planted(t.orders, last_order_day(t))


def patchy_transactions(t: Tables) -> DataFrame:
    """The same without one customer in 11, for the checks of missing activity."""
    return _planted(t.orders.where(F.col("o_custkey") % 11 != 0), last_order_day(t))


def _planted(orders: DataFrame, end: Column) -> DataFrame:
    k = F.col("o_orderkey")
    ordered = F.col("o_orderdate").cast("date")
    amount = (
        F.when(k % 41 == 0, F.lit(None))
        .when(k % 43 == 0, -F.col("o_totalprice"))
        .when(k % 47 == 0, F.col("o_totalprice") * 1000)
        .otherwise(F.col("o_totalprice"))
    )
    customer = (
        F.when(k % 53 == 0, F.lit(None)).when(k % 59 == 0, F.lit("  ")).otherwise(F.col("o_custkey").cast("string"))
    )
    dated = (
        F.when(k % 61 == 0, F.date_add(end, 30))
        .when(k % 67 == 0, F.lit("1990-01-01").cast("date"))
        .when(k % 71 == 0, F.lit(None))
        .otherwise(ordered)
    )
    spiked = F.when(dated.isNotNull() & (k % 97 == 0), F.lit(SPIKE_DAY).cast("date")).otherwise(dated)
    copies = F.when(k % 37 == 0, F.array(F.lit(""), F.lit("-dup"))).otherwise(F.array(F.lit("")))
    rows = orders.select(
        k.cast("string").alias("_id"),
        F.explode(copies).alias("_copy"),
        customer.alias("customer_id"),
        amount.alias("tx_amount"),
        spiked.alias("tx_date"),
    )
    return rows.select(F.concat("_id", "_copy").alias("transaction_id"), "customer_id", "tx_amount", "tx_date")


def raw_customers(t: Tables) -> DataFrame:
    """Profiles with planted gaps, blank regions, bad dates and repeated customers."""
    return _damaged(customers(t), last_order_day(t))


def patchy_customers(t: Tables) -> DataFrame:
    """The same without one customer in 13, for the checks of missing profiles."""
    return _damaged(known_customers(t), last_order_day(t))


def _damaged(profiles: DataFrame, end: Column) -> DataFrame:
    c = F.col("customer_id").cast("bigint")
    region = F.when(c % 31 == 0, F.lit(None)).when(c % 29 == 0, F.lit("  ")).otherwise(F.col("region"))
    registered = (
        F.when(c % 23 == 0, F.date_add(end, 1))
        .when(c % 19 == 0, F.lit("1980-01-01").cast("date"))
        .otherwise(F.col("registration_date"))
    )
    shifts = F.when(c % 17 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        profiles
        .select("customer_id", registered.alias("registered"), region.alias("region"), F.explode(shifts).alias("shift"))
        .select("customer_id", F.date_add("registered", F.col("shift")).alias("registration_date"), "region")
    )


def scoring_customers(t: Tables) -> DataFrame:
    """Customers with an age and an income; some ages exceed 100, some incomes are negative."""
    return t.customer.select(
        F.col("c_custkey").cast("int").alias("customer_id"),
        (F.col("c_custkey") % 120).cast("double").alias("age"),
        (F.col("c_acctbal") * 200).alias("income"),
        F.col("c_mktsegment").alias("region"),
    )


def demo_transactions(t: Tables, *wanted: str) -> DataFrame:
    """One row per order line with the ``wanted`` attributes of its order, customer and product (default: all).

    Only the tables that hold a wanted attribute are joined: an inner join is never dropped by the optimizer.
    Attributes without a source in the test tables are derived from keys, and some have planted gaps.
    """
    c, o = F.col("o_custkey"), F.col("l_orderkey")
    columns = {
        "customer_id": c.cast("string"),
        "order_id": o.cast("string"),
        "amount": F.col("l_extendedprice"),
        "region": F.col("r_name"),
        "city": F.col("n_name"),
        "date": F.col("o_orderdate").cast("date"),
        "segment": F.col("c_mktsegment"),
        "customer_age": (18 + c % 60).cast("int"),
        "customer_gender": F.when(c % 29 != 0, pick(c, ["f", "m"])),
        "registration_date": F.date_add(F.lit("1995-01-01").cast("date"), (c % 365).cast("int")),
        "acquisition_channel": pick(c, CHANNELS),
        "quantity": F.col("l_quantity"),
        "is_discounted": F.when(F.col("l_discount") > 0, 1).otherwise(0),
        "is_returned": F.when(F.col("l_returnflag") == "R", 1).otherwise(0),
        "is_fraud": F.when(o % 97 == 0, 1).otherwise(0),
        "email": F.when(c % 13 == 0, F.lit(None)).when(c % 17 == 0, F.lit(" ")).otherwise(F.concat(c.cast("string"), F.lit("@example.com"))),
        "session_id": F.when(o % 31 != 0, F.md5(o.cast("string"))),
        "device_type": pick(o, ["desktop", "mobile", "tablet"]),
        "payment_method": pick(o, ["card", "cash", "credit", "online"]),
        "product_id": F.col("l_partkey").cast("string"),
        "product_category": F.col("p_type"),
        "lat": (c * 37) % 1800 / 10.0 - 90.0,
        "lon": (c * 91) % 3600 / 10.0 - 180.0,
    }
    names = wanted or tuple(columns)
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    # Orders take on their customer first, so the larger line table is shuffled once, by order.
    if {"region", "city"} & set(names):
        places = customer_places(t).select("c_custkey", "c_mktsegment", "n_name", "r_name")
        orders = orders.join(places, F.col("o_custkey") == F.col("c_custkey"))
    elif "segment" in names:
        people = t.customer.select("c_custkey", "c_mktsegment")
        orders = orders.join(people, F.col("o_custkey") == F.col("c_custkey"))
    lines = t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if "product_category" in names:
        lines = lines.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    return lines.select(*[columns[n].alias(n) for n in names])


def channel_indicators(df: DataFrame) -> DataFrame:
    """Add a 0/1 column per acquisition channel."""
    return df.withColumns({f"channel_{n}": (F.col("acquisition_channel") == n).cast("int") for n in CHANNELS})


def order_totals(t: Tables) -> DataFrame:
    """Orders without the attributes of their customer."""
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("client_id"),
        F.col("o_totalprice").alias("order_amount"),
    )


def client_tiers(t: Tables) -> DataFrame:
    """Clients with their tier only, straight from the customer table."""
    return t.customer.select(
        F.col("c_custkey").cast("string").alias("client_id"), F.col("c_mktsegment").alias("loyalty_level")
    )


def pick(key: Column, names: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (key % len(names) + 1).cast("int"))


def event_orders(t: Tables) -> DataFrame:
    """Events as orders with a time of day."""
    return t.events.select(
        F.col("event_id").cast("string").alias("order_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("value").alias("amount"),
        F.col("ts").alias("order_time"),
        F.col("event_type"),
    )
