"""Exact nearest neighbours without comparing all pairs.

A k-d tree cuts the space into boxes of similar weight. Each point first finds its k-th neighbour
inside its own box, which bounds the search radius; it is then compared only with the boxes that its
ball reaches, which it finds by descending the tree. Equal points are one row with a count, so copies
never fill a box.

The tree has two levels. The first, of at most ``TOP_BOXES`` boxes, is grown from a bounded sample and
known to every task. Where that many boxes would be too large, each of them is cut again by a tree of
its own, grown from its own sample in one task and met by points and balls of that box alone. So what
the driver holds does not grow with the points. Rows that meet a box are dealt out in blocks, and the
box is copied to each, so a box in a dense place that many balls reach is no single task.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.functions.defaults import SEED
from tallymart.functions.hashing import unit_interval
from tallymart.session import stable

BOX_ROWS = 1024
TOP_BOXES = 4096
SAMPLE_PER_BOX = 32
#: Rows of one box that a task looks at, in assigning boxes and in comparing.
ASSIGNED, ASKED = 200_000, 8192
#: Pairs of points that a worker compares at a time: half a dozen arrays of that many numbers.
PAIRS = 1 << 18


@dataclass
class Tree:
    """Nodes in arrays: the cut, the children (-1 for a box), the number of the box, and the corners of the region."""

    axis: np.ndarray
    value: np.ndarray
    children: np.ndarray
    box: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def locate(self, data: np.ndarray) -> np.ndarray:
        """The box of each point."""
        at, every = np.zeros(len(data), dtype="int64"), np.arange(len(data))
        while True:
            inner = self.box[at] < 0
            if not inner.any():
                return self.box[at].astype("int32")
            right = (data[every, self.axis[at]] > self.value[at]).astype("int64")
            at = np.where(inner, self.children[at, right], at)

    def reached(self, data: np.ndarray, limits: np.ndarray, block: int = 4096) -> tuple[np.ndarray, np.ndarray]:
        """(row, box) of every box within the squared distance ``limits`` of a point: subtrees out of reach are not entered."""
        rows_found, boxes_found = [np.zeros(0, dtype="int64")], [np.zeros(0, dtype="int32")]
        for start in range(0, len(data), block):
            rows = np.arange(start, min(start + block, len(data)))
            nodes = np.zeros(len(rows), dtype="int64")
            while len(rows):
                gap = np.maximum(np.maximum(self.low[nodes] - data[rows], data[rows] - self.high[nodes]), 0.0)
                near = (gap * gap).sum(axis=1) <= limits[rows] * (1 + 1e-9)
                rows, nodes = rows[near], nodes[near]
                inner = self.box[nodes] < 0
                rows_found.append(rows[~inner])
                boxes_found.append(self.box[nodes[~inner]].astype("int32"))
                rows, nodes = np.repeat(rows[inner], 2), self.children[nodes[inner]].ravel()
        return np.concatenate(rows_found), np.concatenate(boxes_found)


def grow(sample: np.ndarray, boxes: int) -> Tree:
    """Median cuts of a sample on its widest axis, until there are ``boxes`` of them or nothing is left to cut."""
    axes = sample.shape[1]
    axis, value, children, box, lows, highs = [], [], [], [], [], []
    made = 0

    def cut(points: np.ndarray, parts: int, low: np.ndarray, high: np.ndarray) -> int:
        nonlocal made
        node = len(axis)
        for column, item in ((axis, 0), (value, 0.0), (children, [-1, -1]), (box, -1), (lows, low), (highs, high)):
            column.append(item)
        spread = np.ptp(points, axis=0) if len(points) else np.zeros(axes)
        wide = int(np.argmax(spread))
        if parts < 2 or spread[wide] <= 0:
            box[node] = made
            made += 1
            return node
        border = float(np.median(points[:, wide]))
        if border == points[:, wide].max():
            border = float(points[:, wide][points[:, wide] < border].max())
        left_high, right_low = high.copy(), low.copy()
        left_high[wide] = right_low[wide] = border
        below = points[:, wide] <= border
        axis[node], value[node] = wide, border
        children[node] = [cut(points[below], parts // 2, low, left_high), cut(points[~below], parts - parts // 2, right_low, high)]
        return node

    cut(sample, boxes, np.full(axes, -np.inf), np.full(axes, np.inf))
    return Tree(np.array(axis), np.array(value), np.array(children), np.array(box), np.array(lows), np.array(highs))


def _array(points: pd.Series, axes: int) -> np.ndarray:
    return np.stack(points.to_numpy()).astype("float64") if len(points) else np.zeros((0, axes))


def _in_order(points: np.ndarray) -> np.ndarray:
    return points[np.lexsort(points.T[::-1])]


def in_blocks(rows: DataFrame, others: DataFrame, keys: list[str], most: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` dealt out in blocks of about ``most`` per key, and ``others`` copied to every block of their key."""
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / most).alias("_blocks"))
    dealt = rows.join(sizes, keys).withColumn("_block", F.pmod(F.xxhash64("point"), F.col("_blocks")))
    copied = others.join(sizes, keys).withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_blocks") - 1)))
    return dealt.drop("_blocks"), copied.drop("_blocks")


@dataclass
class Boxes:
    """Points in boxes (point, weight, top, sub), and how to find the boxes that balls reach."""

    points: DataFrame
    reach: Callable[[DataFrame], DataFrame]


def boxed(points: DataFrame, axes: int, seed: int = SEED, box_rows: int = BOX_ROWS, top_boxes: int = TOP_BOXES) -> Boxes:
    """Cut stored ``points`` (point, weight) into boxes of about ``box_rows``.

    Up to ``top_boxes`` boxes need one level. Beyond, the first level has about as many boxes as each of them has
    on the second.
    """
    spark = points.sparkSession
    total = points.count()
    boxes = max(total // box_rows, 1)
    tops = boxes if boxes <= top_boxes else min(top_boxes, ceil(sqrt(boxes)))
    subs = ceil(boxes / tops)

    def drawn(boxes: int, salt: str) -> Column:
        return unit_interval("point", F.lit(f"{seed}|{salt}")) < min(1.0, boxes * SAMPLE_PER_BOX / max(total, 1))

    sample = points.where(drawn(tops, "top")).select("point").toPandas()["point"]
    shared = spark.sparkContext.broadcast(grow(_in_order(_array(sample, axes)), tops))

    @F.pandas_udf(T.IntegerType())
    def top_of(point: pd.Series) -> pd.Series:
        return pd.Series(shared.value.locate(_array(point, axes)))

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def tops_reached(point: pd.Series, reach: pd.Series) -> pd.Series:
        rows, found = shared.value.reached(_array(point, axes), reach.to_numpy())
        order = np.argsort(rows, kind="stable")
        cuts = np.searchsorted(rows[order], np.arange(1, len(point)))
        return pd.Series(np.split(found[order], cuts)[: len(point)])

    placed = points.select("point", "weight", top_of("point").alias("top"))

    def first_level(balls: DataFrame) -> DataFrame:
        return balls.select("point", "reach", F.explode(tops_reached("point", "reach")).alias("top"))

    if subs == 1:
        return Boxes(stable(placed.withColumn("sub", F.lit(0))), lambda balls: first_level(balls).withColumn("sub", F.lit(0)))

    def second(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"top": [rows["top"].iloc[0]], "tree": [pickle.dumps(grow(_in_order(_array(rows["point"], axes)), subs))]})

    def sub_of(rows: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        subs = pickle.loads(trees["tree"].iloc[0]).locate(_array(rows["point"], axes)) if len(trees) else 0
        return rows[["point", "weight", "top"]].assign(sub=subs)

    def subs_reached(balls: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        if not len(trees):
            return balls[["point", "reach", "top"]].assign(sub=0)
        rows, found = pickle.loads(trees["tree"].iloc[0]).reached(_array(balls["point"], axes), balls["reach"].to_numpy())
        return balls[["point", "reach", "top"]].iloc[rows].assign(sub=found)

    def met(rows: DataFrame, function, schema: str) -> DataFrame:
        dealt, copied = in_blocks(rows, trees, ["top"], ASSIGNED)
        return dealt.groupBy("top", "_block").cogroup(copied.groupBy("top", "_block")).applyInPandas(function, schema)

    placed = stable(placed)
    trees = stable(placed.where(drawn(boxes, "sub")).groupBy("top").applyInPandas(second, "top int, tree binary"))
    inside = stable(met(placed, sub_of, "point array<double>, weight bigint, top int, sub int"))
    return Boxes(inside, lambda balls: met(first_level(balls), subs_reached, "point array<double>, reach double, top int, sub int"))


def balls(boxes: Boxes, axes: int, k: int) -> DataFrame:
    """(point, reach): the squared distance within which a point's own box has k others; infinite if it has fewer."""

    def radius(box: pd.DataFrame) -> pd.DataFrame:
        data = np.stack(box["point"].to_numpy())
        weights = box["weight"].to_numpy()
        found = np.full(len(data), np.inf)
        for start, squared, left in compared(data, data, weights):
            squared = np.where(left > 0, squared, np.inf)
            keep = min(k, squared.shape[1])
            near = np.argpartition(squared, keep - 1, axis=1)[:, :keep]
            distance = np.take_along_axis(squared, near, axis=1)
            order = np.argsort(distance, axis=1)
            distance = np.take_along_axis(distance, order, axis=1)
            copies = np.take_along_axis(np.maximum(left, 0), np.take_along_axis(near, order, axis=1), axis=1)
            reached = np.cumsum(copies, axis=1) >= k
            rows = np.flatnonzero(reached.any(axis=1))
            found[start + rows] = distance[rows, reached[rows].argmax(axis=1)]
        return pd.DataFrame({"point": box["point"], "reach": found})

    return boxes.points.groupBy("top", "sub").applyInPandas(radius, "point array<double>, reach double")


def compared(queries: np.ndarray, data: np.ndarray, weights: np.ndarray):
    """Per block of queries: its start, squared distances to the points, and the points' weights without the query."""
    block = max(1, PAIRS // max(1, len(data)))
    for start in range(0, len(queries), block):
        part = queries[start : start + block]
        squared = np.zeros((len(part), len(data)))
        same = np.ones((len(part), len(data)), dtype=bool)
        for axis in range(data.shape[1]):
            gap = part[:, axis : axis + 1] - data[None, :, axis]
            squared += gap * gap
            same &= gap == 0
        yield start, squared, weights[None, :] - same


def nearest_neighbours(
    points: DataFrame, axes: int, k: int, seed: int = SEED, box_rows: int = BOX_ROWS, top_boxes: int = TOP_BOXES
) -> DataFrame:
    """Add ``neighbours``, the k nearest neighbours of each point.

    ``points`` has distinct ``point array<double>`` of ``axes`` numbers and ``weight``, the count of
    equal points. Each copy counts as a neighbour; a point is not its own neighbour. Ties go by value.
    The caller passes stored rows, since points are read more than once.
    """

    def match(queries: pd.DataFrame, box: pd.DataFrame) -> pd.DataFrame:
        found: list[pd.DataFrame] = []
        if len(queries) and len(box):
            asked, limits = np.stack(queries["point"].to_numpy()), queries["reach"].to_numpy()
            data = np.stack(box["point"].to_numpy())
            by_value = np.lexsort(data.T[::-1])
            data, weights = data[by_value], box["weight"].to_numpy()[by_value]
            for start, squared, left in compared(asked, data, weights):
                squared = np.where((left > 0) & (squared <= limits[start : start + len(squared), None]), squared, np.inf)
                keep = min(k, squared.shape[1])
                border = np.partition(squared, keep - 1, axis=1)[:, keep - 1 : keep]
                closer, tied = squared < border, squared == border
                room = keep - closer.sum(axis=1, keepdims=True)
                chosen = (closer | (tied & (np.cumsum(tied, axis=1) <= room))) & np.isfinite(squared)
                i, j = np.nonzero(chosen)
                found.append(
                    pd.DataFrame(
                        {
                            "point": list(asked[start + i]),
                            "near": list(data[j]),
                            "distance": squared[i, j],
                            "copies": left[i, j],
                        }
                    )
                )
        columns = ["point", "near", "distance", "copies"]
        return pd.concat(found, ignore_index=True) if found else pd.DataFrame({c: [] for c in columns})

    boxes = boxed(points, axes, seed, box_rows, top_boxes)
    # The balls are stored between, or every task would hold a Python worker for them and one for the tree.
    asked = stable(boxes.reach(stable(balls(boxes, axes, k))))
    dealt, copied = in_blocks(asked, boxes.points, ["top", "sub"], ASKED)
    keys = ["top", "sub", "_block"]
    found = dealt.groupBy(*keys).cogroup(copied.groupBy(*keys)).applyInPandas(match, "point array<double>, near array<double>, distance double, copies bigint")
    listed = found.groupBy("point").agg(F.array_sort(F.collect_list(F.struct("distance", "near", "copies"))).alias("_all"))
    repeated = F.flatten(
        F.transform("_all", lambda e: F.array_repeat(e["near"], F.least(e["copies"], F.lit(k)).cast("int")))
    )
    neighbours = listed.select("point", F.slice(repeated, 1, k).alias("neighbours"))
    return points.join(neighbours, "point")
