"""Cross moments of many columns in one pass.

Every pair of columns has its own rows, those without a gap in either, so a pair needs a count, two means, two
squared deviations and a product. A task gathers them for all pairs by matrix products over Arrow batches, with
values taken relative to the first one it meets, so a large offset costs no digits. What leaves a task is one row
per pair. Partial results are merged around a common reference, which is exact and independent of their order up
to rounding. Work per row is the square of the columns in a matrix product, not an aggregate per pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.session import stable

PARTIAL = "i int, j int, n double, mean_x double, mean_y double, square_x double, square_y double, product double, odd double"
ROWS = 8192


class Gathered:
    """Moments of the rows seen so far: ``n[i, j]`` rows have both values, ``sum[i, j]`` adds up column i over them, and so on."""

    def __init__(self, columns: int) -> None:
        self.origin = np.full(columns, np.nan)
        self.n, self.sum, self.square, self.product, self.odd = (np.zeros((columns, columns)) for _ in range(5))

    def add(self, values: np.ndarray, there: np.ndarray) -> None:
        """Rows of values; ``there`` tells which are no gap. Values that are no finite numbers are counted apart."""
        odd = there & ~np.isfinite(values)
        good = there & ~odd
        for c in np.flatnonzero(np.isnan(self.origin) & good.any(axis=0)):
            self.origin[c] = values[good[:, c].argmax(), c]
        x = np.where(good, values - np.nan_to_num(self.origin), 0.0)
        held, seen = good.astype(float), there.astype(float)
        self.n += held.T @ held
        self.sum += x.T @ held
        self.square += (x * x).T @ held
        self.product += x.T @ x
        self.odd += odd.astype(float).T @ seen + seen.T @ odd.astype(float)

    def rows(self) -> pa.RecordBatch:
        i, j = np.triu_indices(len(self.origin), 1)
        n = self.n[i, j]
        some = np.maximum(n, 1)
        x, y = self.sum[i, j], self.sum[j, i]
        origin = np.nan_to_num(self.origin)
        columns = [
            n,
            origin[i] + x / some,
            origin[j] + y / some,
            np.maximum(self.square[i, j] - x * x / some, 0.0),
            np.maximum(self.square[j, i] - y * y / some, 0.0),
            self.product[i, j] - x * y / some,
            self.odd[i, j],
        ]
        kept = np.flatnonzero((n > 0) | (self.odd[i, j] > 0))
        names = ["i", "j", "n", "mean_x", "mean_y", "square_x", "square_y", "product", "odd"]
        return pa.RecordBatch.from_arrays([pa.array(v[kept].astype(np.int32)) for v in (i, j)] + [pa.array(c[kept]) for c in columns], names)


def _partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: Gathered | None = None
    for batch in batches:
        found = found or Gathered(batch.num_columns)
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            there = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in part.columns])
            values = np.column_stack([pc.fill_null(c, 0.0).to_numpy(zero_copy_only=False) for c in part.columns])
            found.add(values, there)
    if found is not None:
        yield found.rows()


def cross_moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """A row per pair of columns with rows in common: left, right, n, mean_x, mean_y, square_x, square_y, product, odd.

    ``n`` rows have finite numbers in both columns; the squares and the product are sums of deviations from the
    means of those rows. ``odd`` is over 0 where a row with both values has one that is NaN or infinite. The input
    is read once; the partial results, a row per pair and task, are stored.
    """
    numbers = df.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(columns)])
    partial = stable(numbers.mapInArrow(_partials, PARTIAL))
    reference = partial.groupBy("i", "j").agg(F.min("mean_x").alias("ref_x"), F.min("mean_y").alias("ref_y"))
    near = partial.join(reference, ["i", "j"]).withColumns({"dx": F.col("mean_x") - F.col("ref_x"), "dy": F.col("mean_y") - F.col("ref_y")})
    n, x, y = F.sum("n"), F.sum(F.col("n") * F.col("dx")), F.sum(F.col("n") * F.col("dy"))

    def between(a: str, b: str, sum_a: Column, sum_b: Column) -> Column:
        return F.sum(F.col("n") * F.col(a) * F.col(b)) - F.coalesce(F.try_divide(sum_a * sum_b, n), F.lit(0.0))

    merged = near.groupBy("i", "j").agg(
        n.cast("bigint").alias("n"),
        (F.max("ref_x") + F.try_divide(x, n)).alias("mean_x"),
        (F.max("ref_y") + F.try_divide(y, n)).alias("mean_y"),
        F.greatest(F.sum("square_x") + between("dx", "dx", x, x), F.lit(0.0)).alias("square_x"),
        F.greatest(F.sum("square_y") + between("dy", "dy", y, y), F.lit(0.0)).alias("square_y"),
        (F.sum("product") + between("dx", "dy", x, y)).alias("product"),
        F.sum("odd").alias("odd"),
    )
    names = F.array(*[F.lit(c) for c in columns])
    return merged.select(names[F.col("i")].alias("left"), names[F.col("j")].alias("right"), "n", "mean_x", "mean_y", "square_x", "square_y", "product", "odd")


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of each pair of columns over the rows without a gap in either, all in one pass.

    NULL where it is undefined: fewer than two such rows, or a column that does not vary over them. NaN where one
    of them holds NaN or an infinite value.
    """
    found = cross_moments(df, columns)
    spread = F.sqrt("square_x") * F.sqrt("square_y")
    value = F.when(F.col("odd") > 0, F.lit(float("nan"))).otherwise(F.try_divide("product", spread))
    every = df.sparkSession.createDataFrame([(a, b) for a, b in combinations(columns, 2)], "left string, right string")
    return every.join(found.select("left", "right", value.alias("correlation")), ["left", "right"], "left")
