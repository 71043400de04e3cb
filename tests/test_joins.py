import pytest
from pyspark.sql import functions as F

from tallymart.operators import joins, marts


@pytest.fixture(scope="module")
def sides(spark):
    facts = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 400).cast("string")))
        .alias("k"),
        F.lit(1).alias("same"),
    )
    names = ["hot", *[f"k{i}" for i in range(0, 400, 2)], "k4", "other"]
    dimension = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "k string, v int")
    return facts, dimension


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("partitions", [1, 7])
def test_detail_join_keeps_every_match(sides, how, partitions):
    facts, dimension = sides
    joined = joins.join_detail(facts.repartition(partitions), dimension, "k", how)
    known = {r["k"]: 0 for r in dimension.collect()}
    for r in dimension.collect():
        known[r["k"]] += 1
    want = sum(max(known.get(r["k"], 0), how == "left") for r in facts.collect())
    assert joined.columns == ["k", "same", "v"] and joined.count() == want


def test_building_the_join_runs_no_job(sides, spark):
    facts, dimension = sides
    spark.sparkContext.setJobGroup("build", "build")
    joins.join_detail(facts, dimension, "k")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("build")


def test_keys_only_in_counts_null_as_a_key(spark):
    left = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    right = spark.createDataFrame([("a",), ("c",)], "k string")
    assert sorted(r["k"] or "" for r in joins.keys_only_in(left, right, "k").collect()) == ["", "b"]
    assert [r["k"] for r in joins.keys_only_in(right, left, "k").collect()] == ["c"]
    both = right.unionByName(spark.createDataFrame([(None,)], "k string"))
    assert [r["k"] for r in joins.keys_only_in(left, both, "k").collect()] == ["b"]


def test_kpis_keep_the_multiplicity_of_clients(spark):
    orders = spark.createDataFrame(
        [("1", "c", 10.0, "X"), ("2", "c", 20.0, "X"), ("3", "d", 5.0, "Y"), ("4", "gone", 1.0, "Y")],
        "order_id string, client_id string, order_amount double, city string",
    )
    clients = spark.createDataFrame(
        [("c", "A", "gold"), ("c", "B", "gold"), ("d", "A", "basic")], "client_id string, city string, loyalty_level string"
    )
    by_city = {r["city"]: (r["total_orders"], r["total_revenue"]) for r in marts.sales_kpis(orders, clients, "city").collect()}
    assert by_city == {"X": (4, 60.0), "Y": (1, 5.0)}
    tiers = marts.sales_kpis(orders, clients, "client_loyalty").collect()
    assert [(r["client_loyalty"], r["avg_order_value"]) for r in tiers] == [("gold", 15.0), ("basic", 5.0)]
