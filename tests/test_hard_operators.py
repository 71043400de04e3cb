"""Neighbours, oversampling, anomalies and segments against brute force and planted cases."""

import tracemalloc

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.sql import functions as F

from tallymart.operators import anomalies, neighbours, oversampling, risk, scaling, segments
from tallymart.session import stable


def brute_force(points, weights, k):
    out = []
    for i, p in enumerate(points):
        found = []
        for j, q in enumerate(points):
            copies = weights[j] - (1 if i == j else 0)
            found += [float(((p - q) ** 2).sum())] * int(min(copies, k))
        out.append(sorted(found)[:k])
    return out


@pytest.mark.parametrize(("box_rows", "top_boxes"), [(8, 4096), (64, 4096), (10_000, 4096), (8, 5), (4, 2)])
def test_neighbours_equal_brute_force(spark, box_rows, top_boxes, monkeypatch):
    monkeypatch.setattr(neighbours, "ASKED", 16)
    monkeypatch.setattr(neighbours, "ASSIGNED", 32)
    draw = np.random.default_rng(3)
    points = np.unique(
        np.vstack([draw.normal(0, 1, (180, 3)), draw.normal(8, 0.1, (60, 3)), [[100.0, 0, 0]], draw.integers(0, 3, (40, 3))]),
        axis=0,
    )
    weights = draw.integers(1, 4, len(points))
    weights[0] = 50
    df = stable(
        spark.createDataFrame(
            [(p.tolist(), int(w)) for p, w in zip(points, weights, strict=True)], "point array<double>, weight bigint"
        )
    )
    found = neighbours.nearest_neighbours(df, 3, 5, box_rows=box_rows, top_boxes=top_boxes).collect()
    assert len(found) == len(points)
    expected = dict(zip(map(tuple, points.tolist()), brute_force(points, weights, 5), strict=True))
    for row in found:
        p = np.array(row["point"])
        distances = [float(((p - np.array(q)) ** 2).sum()) for q in row["neighbours"]]
        assert distances == pytest.approx(expected[tuple(row["point"])])


def test_neighbours_do_not_depend_on_partitioning(spark):
    draw = np.random.default_rng(4)
    rows = [([float(a), float(b)], 1) for a, b in draw.integers(0, 1000, (300, 2))]
    df = spark.createDataFrame(list({tuple(p): (p, w) for p, w in rows}.values()), "point array<double>, weight bigint")

    def run(partitions, top_boxes=4096):
        found = neighbours.nearest_neighbours(df.repartition(partitions), 2, 4, box_rows=16, top_boxes=top_boxes).collect()
        return sorted((tuple(r["point"]), str(r["neighbours"])) for r in found)

    assert run(1) == run(7) == run(3, top_boxes=6)


def test_reached_boxes_equal_a_scan_of_all():
    draw = np.random.default_rng(6)
    sample = draw.normal(size=(900, 3))
    tree = neighbours.grow(sample, 100)
    leaves = np.flatnonzero(tree.box >= 0)
    data, limits = draw.normal(size=(200, 3)), draw.random(200) * 0.5
    limits[:3] = [0.0, np.inf, 1e-30]
    rows, boxes = tree.reached(data, limits, block=17)
    gap = np.maximum(np.maximum(tree.low[leaves] - data[:, None], data[:, None] - tree.high[leaves]), 0)
    want = np.argwhere((gap**2).sum(axis=2) <= limits[:, None] * (1 + 1e-9))
    assert sorted(zip(rows.tolist(), boxes.tolist(), strict=True)) == sorted((int(i), int(tree.box[leaves[j]])) for i, j in want)
    assert (tree.locate(sample) >= 0).all() and len(leaves) == 100


def test_compared_blocks_are_small():
    draw = np.random.default_rng(8)
    queries, data = draw.normal(size=(2000, 3)), draw.normal(size=(2048, 3))
    tracemalloc.start()
    try:
        for start, squared, left in neighbours.compared(queries, data, np.ones(len(data), "int64")):
            near = np.argpartition(np.where(left > 0, squared, np.inf), 4, axis=1)[:, :5]
            assert near.shape == (len(squared), 5) and start + len(squared) <= len(queries)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert start + len(squared) == len(queries) and peak < 64e6


def test_no_task_of_the_first_level_holds_two_python_workers(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(neighbours, "stable", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or stable(df))
    points = spark.range(200).select(F.array(F.rand(1), F.rand(2)).alias("point"), F.lit(1).cast("bigint").alias("weight"))
    assert neighbours.nearest_neighbours(stable(points), 2, 3, box_rows=16).count() == 200
    kinds = [[k for k in ("FlatMapGroupsInPandas", "ArrowEvalPython") if k in p] for p in plans]
    assert ["FlatMapGroupsInPandas"] in kinds and ["ArrowEvalPython"] in kinds and all(len(k) < 2 for k in kinds)


def compared_per_point(spark, n, **how):
    """How many points each point is compared with after its own box."""
    points = spark.range(n).select(F.array(*[F.rand(k) for k in (1, 2, 3)]).alias("point"), F.lit(1).cast("bigint").alias("weight"))
    boxes = neighbours.boxed(stable(points), 3, **how)
    sizes = boxes.points.groupBy("top", "sub").agg(F.count(F.lit(1)).alias("n"))
    asked = boxes.reach(neighbours.balls(boxes, 3, 5))
    return asked.join(sizes, ["top", "sub"]).agg(F.sum("n")).first()[0] / n


def test_comparisons_per_point_stay_flat(spark):
    few = compared_per_point(spark, 10_000, box_rows=256)
    assert compared_per_point(spark, 80_000, box_rows=256) < 1.6 * few
    assert compared_per_point(spark, 80_000, box_rows=256, top_boxes=64) < 1.8 * few


@pytest.fixture(scope="module")
def unbalanced(spark):
    draw = np.random.default_rng(5)
    rows = [(f"a{i}", float(x), float(y), 0) for i, (x, y) in enumerate(draw.normal(0, 1, (300, 2)))]
    rows += [(f"b{i}", float(x), float(y), 1) for i, (x, y) in enumerate(draw.normal(5, 1, (60, 2)))]
    rows += [(f"c{i}", 9.0, 9.0, 1) for i in range(30)]  # a third of the minority are copies
    return spark.createDataFrame(rows, "k string, x double, y double, label int")


def test_oversampling_balances_on_segments(unbalanced):
    made = oversampling.oversample_minority(unbalanced, ["x", "y"], "label", "k").collect()
    assert sum(r["label"] == 1 for r in made) == sum(r["label"] == 0 for r in made) == 300
    minority = np.array([[r["x"], r["y"]] for r in unbalanced.where("label = 1").collect()])
    synthetic = np.array([[r["x"], r["y"]] for r in made if r["is_synthetic"]])
    assert len(synthetic) == 210 and len(np.unique(synthetic, axis=0)) > 100
    starts, ends = minority[:, None, :], minority[None, :, :]
    direction = ends - starts
    length = (direction**2).sum(axis=2)
    for p in synthetic:
        along = np.clip(((p - starts) * direction).sum(axis=2) / np.where(length == 0, 1, length), 0, 1)
        gap = ((starts + along[..., None] * direction - p) ** 2).sum(axis=2)
        assert gap.min() < 1e-18


def test_oversampling_does_not_depend_on_partitioning(unbalanced):
    def run(partitions):
        made = oversampling.oversample_minority(unbalanced.repartition(partitions), ["x", "y"], "label", "k")
        return sorted((r["x"], r["y"], r["label"], r["is_synthetic"]) for r in made.collect())

    assert run(1) == run(6)


def test_oversampling_leaves_hopeless_input_alone(unbalanced):
    one = unbalanced.where("label = 0")
    assert oversampling.oversample_minority(one, ["x", "y"], "label", "k").count() == 300
    few = one.unionByName(unbalanced.where("label = 1").limit(5))
    assert oversampling.oversample_minority(few, ["x", "y"], "label", "k").where("is_synthetic = 1").count() == 0


def test_a_tiny_class_does_not_stop_the_others(unbalanced, spark):
    tiny = spark.createDataFrame([(f"t{i}", 0.0, float(i), 2) for i in range(3)], "k string, x double, y double, label int")
    columns = ["k", "x", "y", "label"]
    rows = unbalanced.select(*[F.col(c).cast(tiny.schema[c].dataType).alias(c) for c in columns]).unionByName(tiny)
    made = oversampling.oversample_minority(rows, ["x", "y"], "label", "k").where("is_synthetic = 1")
    assert {r["label"]: r["count"] for r in made.groupBy("label").count().collect()} == {1: 210}


@pytest.mark.parametrize("keys", [1, 3, 10])
def test_oversampling_under_repeated_keys(unbalanced, keys):
    rows = unbalanced.withColumn("k", (F.xxhash64("k") % keys).cast("string"))
    made = oversampling.oversample_minority(rows, ["x", "y"], "label", "k")
    counts = {r["label"]: r["count"] for r in made.groupBy("label").count().collect()}
    assert len(set(counts.values())) == 1


def test_oversampling_refuses_missing_labels(unbalanced):
    with pytest.raises(ValueError, match="no label"):
        oversampling.oversample_minority(unbalanced.withColumn("label", F.lit(None).cast("int")), ["x", "y"], "label", "k")


@pytest.fixture(scope="module")
def crowd(spark):
    draw = np.random.default_rng(6)
    usual = [(f"u{i}", *map(float, row)) for i, row in enumerate(draw.normal(0, 1, (970, 4)))]
    odd = [(f"o{i}", *map(float, row)) for i, row in enumerate(draw.normal(0, 1, (30, 4)) + 12)]
    columns = "customer_id string, " + ", ".join(f"{c} double" for c in risk.SEGMENT_FEATURES)
    return spark.createDataFrame(usual + odd, columns)


def test_forest_finds_planted_outliers(crowd):
    flagged = anomalies.detect_anomalies(crowd, contamination=0.05)
    assert flagged.where("is_anomaly = 1").count() == 50
    assert flagged.where("is_anomaly = 1 AND customer_id LIKE 'o%'").count() == 30
    assert flagged.where("(anomaly_score = -1) <> (is_anomaly = 1)").count() == 0


def test_each_tree_gets_its_sample(crowd):
    sizes = anomalies.tree_samples(crowd, "customer_id", risk.SEGMENT_FEATURES, 1000, 20, 64, 1).groupBy("tree").count()
    assert [r["count"] for r in sizes.collect()] == [64] * 20


def test_forest_does_not_depend_on_partitioning(crowd):
    def run(partitions):
        flagged = anomalies.detect_anomalies(crowd.repartition(partitions), trees=20, size=64)
        return sorted((r["customer_id"], r["anomaly_degree"]) for r in flagged.collect())

    assert run(1) == run(5)


def test_mean_path_matches_the_harmonic_formula():
    for n in (20, 100, 256):
        harmonic = sum(1 / i for i in range(1, n))
        assert anomalies.mean_path(n) == pytest.approx(2 * harmonic - 2 * (n - 1) / n, rel=0.03)
    assert anomalies.mean_path(1) == 0.0 and anomalies.mean_path(2) == 1.0


def test_segments_are_ordered_by_spending_and_no_worse_than_one_run(base):
    found = segments.customer_segments(base, restarts=4)
    means = [r["m"] for r in found.groupBy("cluster").agg(F.avg("total_spent").alias("m")).orderBy("cluster").collect()]
    assert means == sorted(means) and len(means) == 3
    vectors = scaling.standardise(scaling.assemble(base, risk.SEGMENT_FEATURES))
    single = KMeans(featuresCol="scaled_features", k=3, seed=1, maxIter=300).fit(vectors).summary.trainingCost
    points = vectors.join(found.select("customer_id", "cluster"), "customer_id")
    arrays = scaling.vector_columns(points, "scaled_features", ["a", "b", "c", "d"])
    spread = arrays.groupBy("cluster").agg(
        *[(F.var_pop(c) * F.count(F.lit(1))).alias(c) for c in "abcd"]
    )
    cost = sum(sum(r[c] for c in "abcd") for r in spread.collect())
    assert cost <= single * 1.0001


def test_segments_do_not_depend_on_partitioning(base):
    def run(partitions):
        found = segments.customer_segments(base.repartition(partitions), restarts=3)
        return sorted((r["customer_id"], r["cluster"]) for r in found.collect())

    assert run(1) == run(4) == run(16)


def blobs(spark, rows, parts):
    """Three clouds of customers, the third of them hot."""
    centre = F.expr("case when id % 5 = 0 then 1000 when id % 5 = 1 then 200 else 10 end")
    noise = lambda k: (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000)) - 500) / 500
    cells = [(centre * (k + 1) + noise(k) * 40).alias(c) for k, c in enumerate(risk.SEGMENT_FEATURES)]
    return spark.range(rows).repartition(parts).select(F.col("id").cast("string").alias("customer_id"), *cells)


def test_segments_around_a_quarter_million_rows(spark):
    """Neither the layout nor a few rows more or less change the start."""
    runs = []
    for rows, parts in ((249_990, 1), (250_010, 4), (250_010, 16)):
        found = segments.customer_segments(blobs(spark, rows, parts), restarts=3)
        runs.append(found.where("cast(customer_id AS bigint) < 249990").agg(F.bit_xor(F.xxhash64("customer_id", "cluster")), F.count_distinct("cluster")).first())
    assert runs[0] == runs[1] == runs[2] and runs[0][1] == 3


def test_settled_centres_equal_a_run_in_memory(spark):
    draw = np.random.default_rng(8)
    points = np.vstack([draw.normal(c, 1, (200, 2)) for c in (0, 6, 13)])
    cost, centres = segments.start_of(points, 3, np.random.default_rng(1))
    rows = spark.createDataFrame([(p.tolist(),) for p in points], "point array<double>")
    again = segments.settled(rows, points[:3].copy())
    assert cost == pytest.approx(sum(((points[k * 200 : k * 200 + 200] - points[k * 200 : k * 200 + 200].mean(axis=0)) ** 2).sum() for k in range(3)), rel=0.05)
    assert np.sort(again, axis=0) == pytest.approx(np.sort(centres, axis=0), abs=0.2)
    model = segments.model_of(centres, spark)
    assert sorted(map(tuple, model.clusterCenters())) == sorted(map(tuple, centres))


def test_fewer_customers_than_segments(spark):
    rows = blobs(spark, 2, 1)
    assert segments.customer_segments(rows, restarts=2).select("cluster").distinct().count() == 2
    with pytest.raises(ValueError, match="no rows"):
        segments.fit_segments(rows.limit(0))


def test_segment_model_scores_new_rows(base, spark, tmp_path):
    model = segments.fit_segments(base, restarts=2)
    model.save(str(tmp_path / "segments"))
    again = segments.SegmentModel.load(str(tmp_path / "segments"))
    assert again.centres() == model.centres()
    some = base.limit(50)
    assert sorted(again.transform(some).collect()) == sorted(model.transform(some).collect())
    empty = some.withColumn("total_spent", F.lit(None).cast("double"))
    assert again.transform(empty).where("cluster IS NULL").count() == 0


def test_anomaly_model_scores_new_rows(crowd, spark, tmp_path):
    model, scored = anomalies.fit_anomalies(crowd, contamination=0.05, trees=20)
    model.save(spark, str(tmp_path / "forest"))
    again = anomalies.AnomalyModel.load(spark, str(tmp_path / "forest"))
    assert sorted(again.transform(crowd).collect()) == sorted(model.flag(scored).collect())
    far = spark.createDataFrame([("new", *[40.0] * 4)], crowd.schema)
    assert again.transform(far).first()["is_anomaly"] == 1
