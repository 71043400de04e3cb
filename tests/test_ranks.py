import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymart.operators import ranks

SHARES = [0.0, 0.1, 0.25, 0.5, 0.73, 0.999, 1.0]


def check_quantiles(spark, values, **options):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = {r["probability"]: r["value"] for r in ranks.exact_quantiles(df, {"x": SHARES}, **options).collect()}
    numbers = [v for v in values if v is not None and not math.isnan(v)]
    for share in SHARES:
        assert found[share] == pytest.approx(np.quantile(numbers, share), abs=1e-9)


@pytest.mark.parametrize("options", [{}, {"limit": 3}, {"accuracy": 4, "limit": 2}])
@pytest.mark.parametrize("rows", [1, 2, 3, 10, 2000])
def test_quantiles_equal_numpy(spark, rows, options):
    draw = random.Random(rows)
    values = [draw.choice([1.0, 2.0, float(draw.randint(0, 9)), draw.random()]) for _ in range(rows)]
    check_quantiles(spark, [*values, None, float("nan")], **options)


def test_quantiles_with_a_hot_value(spark):
    check_quantiles(spark, [7.0] * 900 + [float(i) for i in range(100)], limit=5)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=40))
def test_quantile_property(spark, values):
    check_quantiles(spark, values, accuracy=4, limit=2)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert ranks.quantile_row(df, {"m": ("x", 0.5)}).first()["m"] is None


@pytest.mark.parametrize("descending", [True, False])
def test_running_totals(spark, descending):
    draw = random.Random(5)
    rows = [(float(v), draw.randint(0, 9)) for v in draw.sample(range(10_000), 700)]
    df = spark.createDataFrame(rows, "v double, n int").repartition(5)
    found = {r["v"]: r["cum_n"] for r in ranks.running_totals(df, "v", ["n"], descending, buckets=16).collect()}
    total, expected = 0, {}
    for v, n in sorted(rows, reverse=descending):
        total += n
        expected[v] = total
    assert found == expected


def test_hash_cutoffs_find_the_nth_hash(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), F.md5(F.col("id").cast("string")).alias("h"))
    quotas = spark.createDataFrame([(0, "a", 17), (0, "b", 1000), (1, "a", 1), (2, "a", 0)], "g long, part string, quota long")
    found = {(r["g"], r["part"]): r["cutoff"] for r in ranks.hash_cutoffs(df, "g", "h", quotas).collect()}
    ordered = {g: sorted(r["h"] for r in df.where(F.col("g") == g).collect()) for g in (0, 1)}
    assert found == {(0, "a"): ordered[0][16], (0, "b"): ordered[0][999], (1, "a"): ordered[1][0]}


def test_hash_cutoffs_with_a_hot_key(spark):
    df = spark.range(900).select(
        F.lit(0).alias("g"), F.md5(F.when(F.col("id") < 300, F.lit("hot")).otherwise(F.col("id").cast("string"))).alias("h")
    )
    hashes = sorted(r["h"] for r in df.collect())
    for quota in (1, 300, 450, 900):
        quotas = spark.createDataFrame([(0, "a", quota)], "g int, part string, quota long")
        assert ranks.hash_cutoffs(df, "g", "h", quotas).first()["cutoff"] == hashes[quota - 1]
