"""Customer segments and their profiles."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.functions.defaults import CLUSTERS, RESTARTS, SEED
from tallymart.functions.hashing import key_hash
from tallymart.functions.rules import existing
from tallymart.operators.risk import SEGMENT_FEATURES
from tallymart.session import stable

#: Rows from which the starts are made; the driver holds no more.
SAMPLE = 20_000


@dataclass
class SegmentModel:
    """A fitted segmentation: ``transform`` gives any customers their segment, ``save`` and ``load`` keep it."""

    pipeline: PipelineModel
    names: list[str]

    @property
    def means(self) -> KMeansModel:
        return self.pipeline.stages[-1]

    def centres(self) -> list[tuple[float, ...]]:
        """Centres of the standardised features in the order of the segments' numbers."""
        found = [tuple(float(x) for x in c) for c in self.means.clusterCenters()]
        return [found[i] for i in self._order(found)]

    def _order(self, centres: list[tuple[float, ...]]) -> list[int]:
        axis = self.names.index("total_spent") if "total_spent" in self.names else 0
        return sorted(range(len(centres)), key=lambda i: (centres[i][axis], centres[i]))

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``cluster``; gaps in the features read as 0."""
        order = self._order([tuple(c) for c in self.means.clusterCenters()])
        numbers = F.array(*[F.lit(str(order.index(i))) for i in range(len(order))])
        return self.scaled(df).select(*df.columns, numbers[F.col("_found")].alias("cluster"))

    def scaled(self, df: DataFrame) -> DataFrame:
        """``df`` with the standardised vector ``_scaled`` and the number ``_found`` of the nearest centre."""
        return self.pipeline.transform(_filled(df, self.names))

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(path)

    @classmethod
    def load(cls, path: str) -> SegmentModel:
        pipeline = PipelineModel.load(path)
        return cls(pipeline, [c.removeprefix("_") for c in pipeline.stages[0].getInputCols()])


def _filled(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({f"_{n}": F.coalesce(F.col(n).cast("double"), F.lit(0.0)) for n in names})


def _spread(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distance of every point to every centre."""
    return ((points[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)


def start_of(points: np.ndarray, clusters: int, draw: np.random.Generator, steps: int = 100) -> tuple[float, np.ndarray]:
    """Cost and centres of one run on a sample: k-means++ draws centres far apart, a few steps settle them."""
    centres = points[[draw.integers(len(points))]]
    while len(centres) < clusters:
        away = _spread(points, centres).min(axis=1)
        if not away.any():
            break  # fewer different points than clusters
        centres = np.vstack([centres, points[draw.choice(len(points), p=away / away.sum())]])
    for _ in range(steps):
        nearest = _spread(points, centres).argmin(axis=1)
        held = np.bincount(nearest, minlength=len(centres))
        sums = np.column_stack([np.bincount(nearest, points[:, c], len(centres)) for c in range(points.shape[1])])
        moved = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], centres)
        if np.array_equal(moved, centres):
            break
        centres = moved
    return float(_spread(points, centres).min(axis=1).sum()), centres


def settled(points: DataFrame, centres: np.ndarray, max_iter: int = 300, tolerance: float = 1e-4) -> np.ndarray:
    """The centres of all points (an array column ``point``) after as many steps as they move; one aggregation a step.

    Centres are rounded to twelve digits, so that the order in which tasks add up does not show.
    """
    axes = range(centres.shape[1])
    for _ in range(max_iter):
        away = [reduce(add, [(F.get("point", F.lit(i)) - float(c[i])) ** 2 for i in axes]) for c in centres]
        nearest = F.array_position(F.array(*away), F.array_min(F.array(*away))).cast("int") - 1
        means = [F.avg(F.get("point", F.lit(i))).alias(f"m{i}") for i in axes]
        found = points.select("point", nearest.alias("nearest")).groupBy("nearest").agg(*means).collect()
        moved = centres.copy()
        for row in found:
            moved[row["nearest"]] = [round(row[f"m{i}"], 12) for i in axes]
        far = ((moved - centres) ** 2).sum(axis=1).max()
        centres = moved
        if far <= tolerance**2:
            break
    return centres


def model_of(centres: np.ndarray, spark: SparkSession) -> KMeansModel:
    """A k-means model with these centres: fitted on nothing but them, each is a cluster of its own."""
    rows = spark.createDataFrame([(Vectors.dense(c),) for c in centres.tolist()], ["_scaled"]).coalesce(1)
    return KMeans(featuresCol="_scaled", predictionCol="_found", k=len(centres), initMode="random", maxIter=1, seed=1).fit(rows)


def fit_segments(
    base: DataFrame,
    clusters: int = CLUSTERS,
    features: list[str] | None = None,
    restarts: int = RESTARTS,
    seed: int = SEED,
    sample: int = SAMPLE,
) -> SegmentModel:
    """K-means on the standardised features; the best of ``restarts`` starts is settled on all rows.

    Starts are made by k-means++ on a bounded sample, the ``sample`` rows whose keys have the smallest hashes, so
    they follow from the rows and the seed, whatever the layout. With no more rows than that the sample is all of
    them, and the result is the best of ``restarts`` whole runs. Segments are numbered by the centre's spending, so
    the numbers do not depend on the run. Rescaling all features by one factor leaves the clusters as they are, so
    the sample deviation serves as well as the population deviation.
    """
    spark, names = base.sparkSession, existing(base, features or SEGMENT_FEATURES)
    rows = stable(base.select("customer_id", *names))
    if rows.isEmpty():
        raise ValueError("there are no rows to fit segments on")
    filled = _filled(rows, names)
    scaling = Pipeline(
        stages=[
            VectorAssembler(inputCols=[f"_{n}" for n in names], outputCol="_raw"),
            StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True),
        ]
    ).fit(filled)
    scaled = scaling.transform(filled).select(key_hash("customer_id", seed).alias("hash"), vector_to_array("_scaled").alias("point"))
    points = stable(scaled)
    first = np.array([r["point"] for r in points.orderBy("hash", "point").limit(sample).collect()])
    starts = [start_of(first, clusters, np.random.default_rng([seed, run])) for run in range(restarts)]
    best = min(starts, key=lambda start: start[0])[1]
    held = points.select("point").persist()
    try:
        centres = settled(held, np.round(best, 12))
    finally:
        held.unpersist()
    return SegmentModel(PipelineModel([*scaling.stages, model_of(centres, spark)]), names)


def customer_segments(base: DataFrame, *args, **params) -> DataFrame:
    """Add ``cluster`` ("0", "1", ...) by a segmentation fitted on the same rows; parameters as ``fit_segments``."""
    return fit_segments(base, *args, **params).transform(base)


def segment_profile(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Mean and sample deviation of four measures and the customers per segment, to two digits.

    Hundredths are rounded as floating-point numbers, half to even.
    """
    measures = [
        (F.rint(fn(m) * 100) / 100).alias(f"{m}_{name}")
        for m in SEGMENT_FEATURES
        for name, fn in (("mean", F.avg), ("std", F.stddev_samp))
    ]
    return df.groupBy(cluster).agg(*measures, F.count("customer_id").alias("customer_count"))


def anomaly_profile(df: DataFrame) -> DataFrame:
    """Means of three measures and the customers per anomaly flag."""
    return df.groupBy("is_anomaly").agg(
        *[F.avg(m).alias(m) for m in ("total_transactions", "total_spent", "days_since_last_transaction")],
        F.count("customer_id").alias("count"),
    )
