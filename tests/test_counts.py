import math
import random
import re

import numpy as np
import pytest

from tallymart.operators import profile, risk, sketches
from tallymart.operators.counts import quantiles_of_counts, value_counts
from tallymart.operators.ranks import exact_quantiles

SHARES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def numbers(seed, n):
    r = random.Random(seed)
    hot = [r.choice([3.0, -1.5]) for _ in range(n // 2)]
    return hot + [r.gauss(0, 100) for _ in range(n - len(hot))]


@pytest.mark.parametrize("n", [1, 2, 7, 3000])
@pytest.mark.parametrize("parts", [1, 9])
def test_quantiles_of_counts(spark, n, parts):
    a, b = numbers(1, n), numbers(2, n)
    rows = spark.createDataFrame([(x, y if k % 3 else None) for k, (x, y) in enumerate(zip(a, b, strict=True))], "a double, b double").repartition(parts)
    found = {(r["column"], r["probability"]): r["value"] for r in quantiles_of_counts(value_counts(rows, ["a", "b"]), {"a": SHARES, "b": [0.5]}).collect()}
    for p in SHARES:
        assert found["a", p] == pytest.approx(np.quantile(a, p))
    b = [y for k, y in enumerate(b) if k % 3]
    assert found.get(("b", 0.5)) == (pytest.approx(np.median(b)) if b else None)
    assert {(r["column"], r["probability"]): pytest.approx(r["value"]) for r in exact_quantiles(rows, {"a": SHARES}).collect()} == {k: v for k, v in found.items() if k[0] == "a"}


def test_profile_of_odd_columns(spark):
    nan = float("nan")
    rows = spark.createDataFrame([(1.0, None, 5, nan), (1.0, None, None, 2.0), (4.0, None, None, 3.0)], "a double, b double, c int, d double")
    for exact in (True, False):
        found = {r["column"]: r for r in profile.column_profile(rows, ["a", "b", "c", "d"], exact).collect()}
        assert (found["a"]["count"], found["a"]["distinct"], found["a"]["min"], found["a"]["max"], found["a"]["mean"]) == (3, 2, 1.0, 4.0, 2.0)
        assert found["a"]["stddev"] == pytest.approx(math.sqrt(3))
        assert found["a"]["median"] == 1.0
        assert tuple(found["b"])[1:] == (0, 0, None, None, None, None, None, None, None)
        assert (found["c"]["count"], found["c"]["stddev"], found["c"]["q1"], found["c"]["q3"]) == (1, None, 5.0, 5.0)
        assert found["d"]["count"] == 3 and math.isnan(found["d"]["mean"])
    assert [r["count"] for r in profile.column_profile(rows.limit(0), ["a"]).collect()] == [0]


def test_profile_reads_its_rows_once(spark, tmp_path):
    """The plan that is left after the map of counts is made does not touch the rows."""
    path = str(tmp_path / "rows")
    spark.range(5000).selectExpr("cast(id % 97 AS double) a", "cast(id AS double) b").write.parquet(path)
    found = profile.column_profile(spark.read.parquet(path), ["a", "b"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search(re.escape(path), plan)
    assert {r["column"]: r["distinct"] for r in found.collect()} == {"a": 97, "b": 5000}


def rank_error(values, found, share):
    """Distance of the share to the range of ranks that the value found has."""
    below, upto = np.mean(values < found), np.mean(values <= found)
    return max(below - share, share - upto, 0)


@pytest.mark.parametrize("size", [128, 4096])
def test_rank_error_of_sketches(spark, size):
    values = np.random.default_rng(1).lognormal(size=60_000)
    rows = spark.createDataFrame([(float(v), int(k % 7)) for k, v in enumerate(values)], "v double, day int").repartition(5)
    parts = sketches.sketches(rows, ["v"], ["day"], size)
    assert parts.count() == 7
    for r in sketches.quantiles(sketches.merged(parts, size=size), SHARES).collect():
        assert r["n"] == 60_000
        assert rank_error(values, r["value"], r["probability"]) <= 3 * sketches.rank_error(size) + 1e-4


def test_sketches_of_nothing(spark):
    rows = spark.createDataFrame([(None, float("nan"))], "a double, b double")
    found = sketches.quantiles(sketches.sketches(rows, ["a", "b"]), [0.5]).collect()
    assert [(r["n"], r["value"]) for r in found] == [(0, None), (0, None)]
    assert tuple(sketches.quantile_row(rows, {"m": ("a", 0.5), "q": ("b", 0.1)}).first()) == (None, None)


def test_thresholds_from_sketches(base):
    close = risk.median_thresholds(base, exact=False).first()
    exact = risk.median_thresholds(base).first()
    for name in ("days_median", "spent_median", "activity_median"):
        assert close[name] == pytest.approx(exact[name], rel=0.1, abs=2)
    assert risk.composite_risk(base, exact=False).count() == base.count()


def test_fence_from_sketches(spark):
    values = np.random.default_rng(2).normal(100, 10, 20_000)
    rows = spark.createDataFrame([(float(v),) for v in values], "v double")
    exact, close = profile.outlier_fence(rows, "v").first(), profile.outlier_fence(rows, "v", exact=False).first()
    assert tuple(close) == pytest.approx(tuple(exact), rel=0.02)
    assert abs(profile.outliers(rows, "v").count() - profile.outliers(rows, "v", exact=False).count()) < 40
