"""A Merkle manifest of a dataset: a leaf per row, a tree per partition, a tree over the partitions' roots, and proofs.

Trees are cut into superblocks of 2^``height`` consecutive nodes. Each superblock is reduced to one node; those
nodes are the leaves of the next layer, which is cut in the same way, until every tree is one superblock. On the way
back, a superblock's nodes are cogrouped with its outer path, the siblings above it up to the root. One function
then finishes the reduction inside the superblock, joins the inner and the outer siblings to a proof for each node,
and folds the node as it is now over its proof. So no task holds more than a superblock and some forty siblings, a
tree that holds a third of all rows is split like any other, and only digests are shuffled.

Exact positions come from a range partitioning and its counts. Leaves are stored first, since a range
partitioning reads its input twice; rows that are equal in every column are spread by a number given when they are stored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.native import same
from tallymart.session import stable


@dataclass(frozen=True)
class Shape:
    """Superblocks hold 2^``height`` nodes."""

    height: int = 12


def field(value: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def hashed(*digests: str) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def levels(nodes: list[str], size: int, height: int) -> list[list[str]]:
    """The levels of a superblock of a tree whose lowest level has ``size`` nodes: ``height`` levels above the nodes
    given, fewer where the tree ends."""
    found = [nodes]
    while size > 1 and len(found) <= height:
        below = found[-1]
        found.append([hashed(*below[k : k + 2]) for k in range(0, len(below), 2)])
        size = (size + 1) // 2
    return found


def path_of(inner: list[list[str]], at: int) -> list[str]:
    """A step per level from node ``at`` of a superblock up: L or R and the sibling on that side, N for none."""
    steps = []
    for level in inner[:-1]:
        other = at ^ 1
        steps.append(("R" if other > at else "L") + level[other] if other < len(level) else "N")
        at >>= 1
    return steps


def fold(digest: str, steps: list[str]) -> str:
    """The root that a node's digest and its path give."""
    for step in steps:
        side, sibling = step[0], step[1:]
        digest = hashed(sibling, digest) if side == "L" else hashed(digest, sibling)
    return digest


def proof(steps: list[str]) -> str:
    """The digest of the path's siblings, in order."""
    return hashed(*[s[1:] for s in steps])


def reducer(shape: Shape) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A superblock's top node."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at")
        tree, block, size = rows["tree"].iloc[0], int(rows["block"].iloc[0]), int(rows["size"].iloc[0])
        (top,) = levels(rows["digest"].tolist(), size, shape.height)[-1]
        above = -(-size >> shape.height) if size > 1 else 1
        return pd.DataFrame({"tree": [tree], "at": [block], "size": [above], "digest": [top]})

    return run


NODE = "tree bigint, at bigint, size bigint, digest string"


def blocked(nodes: DataFrame, shape: Shape) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("at", shape.height))


def finisher(shape: Shape, *carried: str) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """A superblock's nodes met by its outer path: a row per node.

    With ``carried`` columns the nodes are leaves and get their proof and the root they lead to; else their paths.
    """

    def run(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at").reset_index(drop=True)
        inner = levels(rows["digest"].tolist(), int(rows["size"].iloc[0]), shape.height)
        above = outer["path"].iloc[0].split()
        paths = [path_of(inner, k) + above for k in range(len(rows))]
        if carried:
            found = rows[[*carried, "digest"]].copy()
            found["proof"] = [proof(p) for p in paths]
            found["folded"] = [fold(d, p) for d, p in zip(rows["now"], paths, strict=True)]
        else:
            found = rows[["tree", "at"]].copy()
            found["path"] = [" ".join(p) for p in paths]
        found["top"], found["root"] = outer["top"].iloc[0], outer["root"].iloc[0]
        return found

    return run


def tops(nodes: DataFrame, shape: Shape) -> list[DataFrame]:
    """The layers from ``nodes`` (tree, at, size, digest) up to a node per tree, each stored."""
    layers = [nodes]
    while (layers[-1].agg(F.max("size")).first()[0] or 0) > 1:
        above = blocked(layers[-1], shape).groupBy("tree", "block").applyInPandas(reducer(shape), NODE)
        layers.append(stable(above))
    return layers


def exchange(nodes: DataFrame, outer: DataFrame, shape: Shape, schema: str, *carried: str) -> DataFrame:
    """Nodes and outer paths (tree, at, path, top, root) cogrouped by superblock."""
    met = blocked(nodes, shape).groupBy("tree", "block").cogroup(outer.withColumnRenamed("at", "block").groupBy("tree", "block"))
    return met.applyInPandas(finisher(shape, *carried), schema)


def descend(layers: list[DataFrame], outer: DataFrame, shape: Shape) -> DataFrame:
    """The paths of the lowest of ``layers``; ``outer`` has those of the highest."""
    for layer in reversed(layers[:-1]):
        outer = stable(exchange(layer, outer, shape, "tree bigint, at bigint, path string, top string, root string"))
    return outer


def numbered(rows: DataFrame, tree: str, order: list[Column]) -> DataFrame:
    """Stored ``rows`` with ``at``, the position in its tree, and ``size``, the tree's rows.

    NULL is a tree of its own. A stretch of the range partitioning is sorted in one task, never a tree.
    """
    stretched = stable(rows.repartitionByRange(F.col(tree), *order).withColumn("stretch", F.spark_partition_id()))
    counts = stretched.groupBy(tree, "stretch").agg(F.count(F.lit(1)).alias("held"))
    part = Window.partitionBy("its_tree")
    counts = counts.select(F.col(tree).alias("its_tree"), F.col("stretch").alias("its_stretch"), "held")
    counts = counts.withColumns({"before": F.sum("held").over(part.orderBy("its_stretch")) - F.col("held"), "size": F.sum("held").over(part)})
    inside = F.row_number().over(Window.partitionBy(tree, "stretch").orderBy(*order)) - 1
    met = same(F.col(tree), F.col("its_tree")) & (F.col("stretch") == F.col("its_stretch"))
    ranked = stretched.withColumn("inside", inside).join(counts, met)
    return ranked.withColumn("at", F.col("inside") + F.col("before")).drop("inside", "before", "held", "its_tree", "its_stretch", "stretch")


def manifest(leaves: DataFrame, shape: Shape = Shape()) -> DataFrame:  # noqa: B008
    """The manifest of ``leaves`` (tree, key, leaf, now): tree, key, leaf, top, root, proof, folded, verified.

    Every tree's leaves ascend by key (NULL first; rows of one key by leaf, then by the digest they have now).
    Neighbours are hashed together two by two, a last one alone, until a node remains, the tree's ``top``; a lone
    leaf is its own top. Tops, NULL's tree first and then in byte order, give the root in the same way. ``now`` is
    the row's digest as it is found today: ``folded`` is the root it leads to over the untouched siblings,
    ``verified`` whether that is the root. ``proof`` is the digest of those siblings. Keys are integers or texts.
    An empty table has no rows.
    """
    kind = leaves.schema["key"].dataType
    rows = stable(leaves.select("tree", "key", "leaf", "now", F.monotonically_increasing_id().alias("spread")))
    rows = numbered(rows, "tree", [F.col(c).asc_nulls_first() for c in ("key", "leaf", "now", "spread")])
    rows = stable(rows.select(F.col("tree").alias("name"), F.col("key").cast("string").alias("key"), "at", "size", F.col("leaf").alias("digest"), "now"))
    # Trees are numbered in byte order and are the leaves of one more tree.
    trees = stable(rows.select(F.col("name").alias("its_name"), F.lit(0).cast("long").alias("all")).distinct())
    trees = numbered(trees, "all", [F.col("its_name").asc_nulls_first()])
    trees = stable(trees.select("its_name", F.col("at").alias("tree"), F.col("size").alias("trees")))
    nodes = rows.join(trees.drop("trees"), same(F.col("name"), F.col("its_name"))).drop("its_name")
    layers = tops(stable(nodes), shape)
    highest = layers[-1].select(F.col("tree").alias("at"), F.col("digest"))
    upper = highest.join(trees.select(F.col("tree").alias("at"), F.col("trees").alias("size")), "at")
    above = tops(stable(upper.select(F.lit(0).cast("long").alias("tree"), "at", "size", "digest")), shape)
    root = above[-1].select("tree", "at", F.lit("").alias("path"), F.col("digest").alias("top"), F.col("digest").alias("root"))
    paths = descend(above, root, shape).select(F.col("at").alias("tree"), "path", "root")
    paths = paths.join(highest.select(F.col("at").alias("tree"), F.col("digest").alias("top")), "tree")
    outer = stable(paths.select("tree", F.lit(0).cast("long").alias("at"), "path", "top", "root"))
    outer = descend(layers[1:], outer, shape) if len(layers) > 1 else outer
    last = "name string, key string, digest string, proof string, folded string, top string, root string"
    found = exchange(layers[0], outer, shape, last, "name", "key")
    return found.select(
        F.col("name").alias("tree"),
        F.col("key").cast(kind).alias("key"),
        F.col("digest").alias("leaf"),
        "top",
        "root",
        "proof",
        "folded",
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def document_leaves(docs: DataFrame) -> DataFrame:
    """(tree, key, leaf) of documents: a digest over id, source, language, length and text; trees are languages."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    return docs.select(F.col("lang").alias("tree"), F.col("doc_id").alias("key"), leaf_digest(*fields).alias("leaf"))


def tampered_report(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:  # noqa: B008
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of ``docs``.

    Rows whose id's checksum is a multiple of 7 are folded as if one were added to their n_chars: they do not
    verify, unless n_chars is NULL. NULL ids are not tampered with; repeated ids and repeated rows are leaves of
    their own. Very long texts are hashed whole; columns beyond the five are ignored. An empty table gives no rows.
    """
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    changed = [c + 1 if k == 3 else c for k, c in enumerate(fields)]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    leaf = leaf_digest(*fields)
    leaves = docs.select(
        F.col("lang").alias("tree"),
        F.col("doc_id").alias("key"),
        leaf.alias("leaf"),
        F.when(hit & F.col("n_chars").isNotNull(), leaf_digest(*changed)).otherwise(leaf).alias("now"),
    )
    found = manifest(leaves, shape)
    return found.select(
        F.col("key").alias("doc_id"),
        "leaf",
        F.col("top").alias("subroot"),
        "root",
        F.col("proof").alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        "verified",
    )
