import math

import pytest

from tallymart.operators import scaling


@pytest.fixture(scope="module")
def rows(spark):
    data = [(1, 10.0, 1.0), (2, 20.0, None), (3, 30.0, 5.0), (4, None, 7.0)]
    return spark.createDataFrame(data, "id int, a double, b double")


def test_assemble_skips_or_raises(rows):
    assert [r["id"] for r in scaling.assemble(rows, ["a", "b"], invalid="skip").collect()] == [1, 3]
    with pytest.raises(Exception, match="handleInvalid"):
        scaling.assemble(rows, ["a", "b"]).collect()


def test_filters_and_cap(spark):
    data = [(1, 0.0, 0.0), (2, 100.0, 2e6), (3, 101.0, 1.0), (4, -1.0, 1.0), (5, 50.0, -1.0), (6, None, 1.0), (7, 1.0, None)]
    df = spark.createDataFrame(data, "id int, age double, income double")
    kept = scaling.capped_income(scaling.valid_scoring_rows(df)).collect()
    assert [(r["id"], r["income"]) for r in kept] == [(1, 0.0), (2, 1_000_000.0)]
    assert [r["income"] for r in scaling.capped_income(df.where("id = 7")).collect()] == [None]


def test_sample_and_population_scaling_differ_by_one_factor(spark):
    df = spark.createDataFrame([(float(i),) for i in range(5)], "a double")
    sample = [r["a_scaled"] for r in scaling.standardise_columns(df, ["a"]).orderBy("a").collect()]
    population = [r["a_scaled"] for r in scaling.standardise_columns(df, ["a"], population=True).orderBy("a").collect()]
    assert [s * scaling.population_factor(5) for s in sample] == pytest.approx(population)
    vectors = scaling.vector_columns(scaling.standardise(scaling.assemble(df, ["a"])), "scaled_features", ["z"])
    assert [r["z"] for r in vectors.orderBy("a").collect()] == pytest.approx(sample)


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "a double")
    assert [r["a_scaled"] for r in scaling.standardise_columns(df, ["a"]).collect()] == [0.0, 0.0]


def test_unit_vectors(spark):
    df = spark.createDataFrame([(3.0, 4.0), (0.0, 0.0)], "a double, b double")
    units = scaling.normalise(scaling.assemble(df, ["a", "b"]), "features")
    found = scaling.vector_columns(units, "normalized_features", ["x", "y"]).collect()
    assert sorted((r["x"], r["y"]) for r in found) == [(0.0, 0.0), (0.6, 0.8)]
    assert math.isclose(found[0]["x"] ** 2 + found[0]["y"] ** 2, 1.0)


def test_category_index(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("c",), (None,)], "region string")
    found = {r["region"]: r["region_index"] for r in scaling.index_categories(df).collect()}
    assert found == {"b": 0.0, "a": 1.0, "c": 2.0, None: 3.0}


def test_stages_are_fitted_on_train_only(spark):
    columns = "region string, " + ", ".join(f"{c} double" for c in scaling.CHURN_FEATURES)
    train = spark.createDataFrame([("x", *[1.0] * 6), ("x", *[2.0] * 6), ("y", *[3.0] * 6)], columns)
    test = spark.createDataFrame([("new", *[1.0] * 6), ("y", *[1.0] * 6), ("x", *[1.0] * 5, None)], columns)
    vectors, names = scaling.churn_vectors(train, test)
    found = scaling.vector_columns(vectors.select("region", "features"), "features", names)
    rows = {r["region"]: (r["region_index"], r["std_tx_amount"], r["std_missing"]) for r in found.collect()}
    assert rows == {"new": (2.0, 1.0, 0.0), "y": (1.0, 1.0, 0.0), "x": (0.0, 0.0, 1.0)}
