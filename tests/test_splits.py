import pytest
from pyspark.sql import functions as F

from tallymart.operators import splits


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(1003).select(
        F.col("id").cast("string").alias("k"), F.when(F.col("id") % 7 == 0, 1).otherwise(0).alias("y")
    )


def test_hash_split_is_complete_and_near_its_share(rows):
    counts = {r["split"]: r["count"] for r in splits.hash_split(rows, "k", 0.8).groupBy("split").count().collect()}
    assert sum(counts.values()) == 1003 and abs(counts["train"] - 802) < 50


def test_stratified_split_is_exact(rows):
    found = splits.stratified_split(rows, "k", "y", 0.3).groupBy("y", "split").count().collect()
    counts = {(r["y"], r["split"]): r["count"] for r in found}
    assert counts[1, "test"] == round(0.3 * 144) and counts[0, "test"] == round(0.3 * 859)
    assert sum(counts.values()) == 1003


@pytest.mark.parametrize("folds", [2, 5])
def test_folds_of_a_class_differ_by_at_most_one(rows, folds):
    found = splits.stratified_folds(rows, "k", "y", folds).groupBy("y", "fold").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in found if r["y"] == label]
        assert len(sizes) == folds and max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("split", [splits.hash_split, None])
def test_splits_do_not_depend_on_partitioning(rows, split):
    def run(partitions):
        df = rows.repartition(partitions)
        parts = splits.hash_split(df, "k") if split else splits.stratified_split(df, "k", "y")
        return sorted(tuple(r) for r in parts.collect())

    assert run(1) == run(4) == run(16)


def test_tiny_classes(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1)], "k string, y int")
    found = {r["k"]: r["split"] for r in splits.stratified_split(df, "k", "y", 0.3).collect()}
    assert found["c"] == "train"
    assert sorted(found[k] for k in "ab") == ["test", "train"]


@pytest.fixture(scope="module")
def ten_keys(spark):
    """345 rows under ten keys; one key has a third of them, and some rows are equal."""
    rows = [("hot" if i % 3 == 0 else f"k{i % 9}", int(i % 4 == 0), i // 2 if i % 5 else 0) for i in range(345)]
    return spark.createDataFrame(rows, "k string, y int, v int")


@pytest.mark.parametrize("share", [0.0, 0.3, 0.5, 1.0])
def test_repeated_keys_are_split_exactly(ten_keys, share):
    found = splits.stratified_split(ten_keys, "k", "y", share)
    counts = {(r["y"], r["split"]): r["count"] for r in found.groupBy("y", "split").count().collect()}
    for y, n in {1: 87, 0: 258}.items():
        test = int(n * share + 0.5)
        assert (counts.get((y, "test"), 0), counts.get((y, "train"), 0)) == (test, n - test)
    assert found.drop("split").exceptAll(ten_keys).isEmpty()
    cut = found.groupBy("y", "k").agg(F.count_distinct("split").alias("n")).where("n > 1").groupBy("y").count().collect()
    assert all(r["count"] <= 1 for r in cut)


@pytest.mark.parametrize("folds", [2, 5, 7])
def test_repeated_keys_fall_into_even_folds(ten_keys, folds):
    found = splits.stratified_folds(ten_keys, "k", "y", folds).groupBy("y", "fold").count().collect()
    for y, n in {1: 87, 0: 258}.items():
        sizes = [r["count"] for r in found if r["y"] == y]
        assert len(sizes) == folds and sum(sizes) == n and max(sizes) - min(sizes) <= 1


def test_repeated_keys_do_not_depend_on_partitioning(ten_keys):
    runs = [sorted(map(tuple, splits.stratified_split(ten_keys.repartition(n), "k", "y").collect())) for n in (1, 4, 16)]
    assert runs[0] == runs[1] == runs[2]


def test_missing_labels_are_refused(spark):
    unlabelled = spark.createDataFrame([("a", 0), ("b", None)], "k string, y int")
    with pytest.raises(ValueError, match="no y"):
        splits.stratified_split(unlabelled, "k", "y")
