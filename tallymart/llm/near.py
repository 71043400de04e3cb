"""Near duplicates by MinHash bands and sequential Bayesian verification.

A document is its set of word shingles; documents with equal sets are one class from the start. Classes that agree
in a whole band of their MinHash signature are candidates. A candidate pair is verified batch by batch of its
signatures: after n values of which m agree, the posterior of the similarity under a flat prior is Beta(m + 1,
n - m + 1), and the pair is pruned once the similarity wanted has less than ``miss`` left. Survivors are compared
on their full sets; only those links count. Components of links give the groups.

Buckets up to ``small`` classes are compared pair by pair. A larger one is compared with its hub first, the member
with the most company over all bands, which joins most of a group of copies with one comparison each. Where members
still lie in different components, the bucket goes through blocks of at most ``block`` members and ``block_bytes`` of sets: ``long_hashes``
more hash values, a byte each, are made for them and compared across components inside the task in the same
sequential way; survivors are compared there on their full sets, and members found linked are one component from
then on. What leaves the task is a spanning forest: at most one link per member, however many pairs are similar.
So no component is lost and no large group is written out in pairs; what stays quadratic is the comparison of
signatures between members that are not linked. Two values of one byte agree a little more often than the sets are
similar, which makes pruning more careful, not less.

Scale: texts are read once for signatures and once more for classes that survive pruning. Stored stages are narrow.
Band buckets are counted with map-side sums before rows are joined to the counts, so adaptive joins can split a hot
bucket, and blocks bound what one task holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import blake2b
from math import exp, lgamma, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.native import same
from tallymart.session import stable

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
MEMO = 200_000
SLICE = 256
GOLD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Near:
    """Links need 100 * intersection >= ``percent`` * union. 36 bands of 5 miss a pair at 0.8 with probability 7e-7."""

    shingle: int = 4
    percent: int = 80
    bands: int = 36
    rows: int = 5
    batch: int = 30
    miss: float = 1e-6
    small: int = 16
    block: int = 1024
    block_bytes: int = 1 << 23
    long_hashes: int = 640

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


class Words(dict):
    """Hash numbers of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        self[word] = n = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        return n


def shingle_set(text: str | None, k: int, memo: Words) -> np.ndarray:
    """Sorted hashes of the distinct shingles; fewer than ``k`` words are one shingle, no words none."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    width = min(k, len(w))
    h = np.full(len(w) - width + 1, width, np.uint64)
    for j in range(width):
        h = (h ^ w[j : j + len(h)]) * GOLD
        h ^= h >> np.uint64(31)
    return np.unique(h)


@lru_cache(maxsize=4)
def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20_240_229)
    return r.integers(0, 2**32, (n, 1), np.uint32), r.integers(0, 2**31, (n, 1), np.uint32) * np.uint32(2) + np.uint32(1)


def signature(shingles: np.ndarray, n: int) -> np.ndarray:
    """The least value of the set under each of ``n`` hash functions."""
    flip, factor = _functions(n)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(n, 2**32 - 1, np.uint32)
    for at in range(0, len(x), 256):
        np.minimum(least, ((x[at : at + 256] ^ flip) * factor).min(axis=1), out=least)
    return least


def node_of(shingles: np.ndarray) -> bytes:
    return blake2b(shingles.tobytes(), digest_size=16).digest()


def signer(near: Near):
    """A map of (doc_id, text_key, text) to (doc_id, text_key, n_shingles, node, signature); an empty set has no node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Words()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                sets = [shingle_set(t, near.shingle, memo) for t in part.column(2).to_pylist()]
                nodes = [node_of(s) if len(s) else None for s in sets]
                signs = [signature(s, near.hashes).tobytes() if len(s) else None for s in sets]
                columns = [pa.array(list(map(len, sets)), pa.int64()), pa.array(nodes, pa.binary()), pa.array(signs, pa.binary())]
                names = ["doc_id", "text_key", "n_shingles", "node", "signature"]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], names)

    return run


def least_matches(near: Near, hashes: int, batch: int) -> list[tuple[int, int]]:
    """(values seen, agreements below which the pair is pruned) after each batch.

    P(similarity >= t | m of n) = P(Binomial(n + 1, t) <= m).
    """
    t, steps = near.percent / 100, []
    for n in [*range(batch, hashes, batch), hashes]:
        tail, m = 0.0, 0
        for m in range(n + 1):
            tail += exp(lgamma(n + 2) - lgamma(m + 1) - lgamma(n + 2 - m) + m * log(t) + (n + 1 - m) * log(1 - t)) if t < 1 else float(m == n)
            if tail >= near.miss:
                break
        steps.append((n, m))
    return steps


def plausible(left: np.ndarray, right: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Rows whose pair of signatures passes every batch; pairs pruned early are not looked at again."""
    alive, agreed, seen = np.arange(len(left)), np.zeros(len(left), np.int64), 0
    for n, least in steps:
        agreed[alive] += (left[alive, seen:n] == right[alive, seen:n]).sum(axis=1)
        alive = alive[agreed[alive] >= least]
        seen = n
    return alive


def _matrix(column, kind: type) -> np.ndarray:
    """A row of numbers per value of a binary column; all values have one length."""
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1)


def band_codes(sign: np.ndarray, near: Near) -> np.ndarray:
    """A 64-bit code of each band of a signature."""
    code = np.zeros(near.bands, np.uint64)
    for part in sign.reshape(near.bands, near.rows).T:
        code = (code ^ part) * GOLD
        code ^= code >> np.uint64(29)
    return code


def long_signer(near: Near):
    """A map of (doc_id, text) to (node, codes of its bands, the long signature, the set's hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Words()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                sets = [s for t in batch.slice(at, SLICE).column(1).to_pylist() if len(s := shingle_set(t, near.shingle, memo))]
                codes = [band_codes(signature(s, near.hashes), near).tobytes() for s in sets]
                signs = [(signature(s, near.long_hashes) & np.uint32(255)).astype(np.uint8).tobytes() for s in sets]
                columns = ([node_of(s) for s in sets], codes, signs, [s.tobytes() for s in sets])
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in columns], ["node", "codes", "signature", "hashes"])

    return run


def pruner(near: Near):
    """A map of (a, b, signature of a, signature of b) to the plausible (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = least_matches(near, near.hashes, near.batch)
        for batch in batches:
            if batch.num_rows:
                left, right = (_matrix(batch.column(k).to_pylist(), np.uint32) for k in (2, 3))
                yield batch.select([0, 1]).take(pa.array(plausible(left, right, steps)))

    return run


class Overlaps:
    """Intersection sizes between sets held together: every distinct hash is a column."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.end = np.cumsum([len(s) for s in sets])
        self.start = self.end - [len(s) for s in sets]
        found, columns = np.unique(np.concatenate(sets), return_inverse=True)
        self.columns = columns.astype(np.int32)
        self.mark = np.zeros(len(found), bool)

    def of(self, x: int, others: np.ndarray) -> np.ndarray:
        own = self.columns[self.start[x] : self.end[x]]
        self.mark[own] = True
        if len(others) < 64:
            shared = np.array([np.count_nonzero(self.mark[self.columns[self.start[y] : self.end[y]]]) for y in others], np.int64)
        else:
            upto = np.concatenate(([0], np.cumsum(self.mark[self.columns], dtype=np.int32)))
            shared = upto[self.end[others]] - upto[self.start[others]]
        self.mark[own] = False
        return shared


def across(near: Near) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A spanning forest of the links between components inside a block pair of a bucket.

    A pair is looked at in its first common band only, and only while its members lie in different components.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        steps = least_matches(near, near.long_hashes, 64)
        sign, codes = _matrix(rows["signature"], np.uint8), _matrix(rows["codes"], np.uint64)
        band, i, j = int(rows["band"].iloc[0]), int(rows["i"].iloc[0]), int(rows["j"].iloc[0])
        size, own, nodes = rows["n_shingles"].to_numpy(), rows["own"].to_numpy(), rows["node"].to_numpy()
        overlaps = Overlaps([np.frombuffer(h, np.uint64) for h in rows["hashes"]])
        label = pd.factorize(rows["root"])[0]
        outside = np.flatnonzero(label != np.bincount(label).argmax())
        rank = np.full(len(rows), -1)
        rank[outside] = np.arange(len(outside))
        links = []
        for x in outside:
            # Rows of the main component, and of the others those that come later; across the two blocks if they differ.
            y = np.flatnonzero((label != label[x]) & ((rank < 0) | (rank > rank[x])) & ((own != own[x]) | (i == j)))
            y = y[100 * np.minimum(size[y], size[x]) >= near.percent * np.maximum(size[y], size[x])]
            if len(y):
                y = y[plausible(np.broadcast_to(sign[x], (len(y), sign.shape[1])), sign[y], steps)]
            if len(y):
                y = y[(codes[y] == codes[x]).argmax(axis=1) == band]
            if len(y):
                shared = overlaps.of(x, y)
                y = y[100 * shared >= near.percent * (size[x] + size[y] - shared)]
            for first in np.unique(label[y], return_index=True)[1]:
                links.append(sorted((nodes[x], nodes[y[first]])))
                label[label == label[y[first]]] = label[x]
        return pd.DataFrame(links, columns=["a", "b"], dtype=object)

    return run


def set_map(near: Near):
    """A map of (doc_id, text) to (node, the set's hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Words()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                sets = [shingle_set(t, near.shingle, memo) for t in batch.slice(at, SLICE).column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([node_of(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "hashes"])

    return run


def linker(near: Near):
    """A map of (a, b, set of a, set of b) to the (a, b) that are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for k in range(batch.num_rows):
                left, right = (np.frombuffer(batch.column(c)[k].as_py(), np.uint64) for c in (2, 3))
                shared = len(np.intersect1d(left, right, assume_unique=True))
                if 100 * shared >= near.percent * (len(left) + len(right) - shared):
                    good.append(k)
            yield batch.select([0, 1]).take(pa.array(good, pa.int64()))

    return run


PAIR = "a binary, b binary"


def prune(pairs: DataFrame, classes: DataFrame, near: Near) -> DataFrame:
    """The pairs whose sizes and signatures allow the similarity, stored."""
    side = classes.select("node", "signature", "n_shingles")
    left = side.toDF("a", "left", "left_n")
    right = side.toDF("b", "right", "right_n")
    small, large = F.least("left_n", "right_n"), F.greatest("left_n", "right_n")
    met = pairs.join(left, "a").join(right, "b").where(100 * small >= near.percent * large)
    return stable(met.select("a", "b", "left", "right").mapInArrow(pruner(near), PAIR))


def verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, near: Near) -> DataFrame:
    """The pairs whose full sets are similar enough, stored. Only the classes in pairs are read again.

    The sets of a pair differ by a fifth at most in size, so a hub's set beside each of its spokes adds no more than
    the spokes' own.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = texts_of(wanted, classes, docs).mapInArrow(set_map(near), "node binary, hashes binary")
    sets = stable(sets.join(wanted, "node", "left_semi"))
    met = pairs.join(sets.toDF("a", "left"), "a").join(sets.toDF("b", "right"), "b")
    return stable(met.select("a", "b", "left", "right").mapInArrow(linker(near), PAIR).distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node: least node of its component, by large-star and small-star rounds.

    Minima are sums of the map tasks joined back, so the star of a hub that holds a third of all rows is split.
    """
    edges = stable(links.select("a", "b").distinct())
    was = None
    while True:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        rows = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        small = rows.select("u", "m").union(rows.where("v != m").select("v", "m")).toDF("a", "b").distinct()
        edges = stable(small)
        now = edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
        if now == was:
            break
        was = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stable(nodes.union(edges.select("b", "b")).distinct())


def buckets(classes: DataFrame, near: Near) -> DataFrame:
    """(band, key, node, members) of every bucket with company, stored."""
    width = 4 * near.rows
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(near.bands - 1)),
        lambda b: F.xxhash64(b, F.substring(F.col("signature"), b * width + 1, F.lit(width))),
    )
    keyed = classes.select("node", F.posexplode(bands).alias("band", "key"))
    company = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    return stable(keyed.join(company, "key"))


def near_pairs(held: DataFrame, near: Near) -> DataFrame:
    """All pairs of small buckets, and every member with the hub of a large one."""
    few = held.where(F.col("members") <= near.small).groupBy("key").agg(F.sort_array(F.collect_list("node")).alias("n"))
    first = few.select(F.posexplode("n").alias("i", "a"), "n")
    pairs = first.select("a", F.explode(F.slice("n", F.col("i") + 2, F.lit(near.small))).alias("b"))
    many = held.where(F.col("members") > near.small)
    company = many.groupBy("node").agg(F.sum("members").alias("company"))
    hubs = many.join(company, "node").groupBy("key").agg(F.max(F.struct("company", "node"))["node"].alias("hub"))
    spokes = many.join(hubs, "key").where("node != hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
    return pairs.union(spokes).distinct()


def texts_of(nodes: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents that stand for the classes; only these texts are handed on."""
    ids = stable(nodes.join(classes, "node").select(F.col("first_id").alias("id")).distinct())
    return docs.select("doc_id", "text").join(ids, same(F.col("doc_id"), F.col("id")), "left_semi")


def split_links(held: DataFrame, groups: DataFrame, classes: DataFrame, docs: DataFrame, near: Near) -> DataFrame:
    """Links across components of large buckets, a spanning forest of each pair of blocks, stored.

    Members of a bucket's main component need not be compared with each other. So blocks of the others meet all
    blocks, and the main component is copied once per block of the others, not once per block of its own.
    """
    many = held.where(F.col("members") > near.small).join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    many = stable(many)
    sizes = many.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    split = sizes.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count(F.lit(1)).alias("roots"))
    rows = stable(many.join(split.where("roots > 1").drop("roots"), "key").withColumn("outside", F.col("root") != F.col("main")))
    nodes = stable(rows.select("node").distinct())
    signed = texts_of(nodes, classes, docs).mapInArrow(long_signer(near), "node binary, codes binary, signature binary, hashes binary")
    signed = signed.join(nodes, "node", "left_semi").dropDuplicates(["node"])
    signed = stable(signed.join(classes.select("node", "n_shingles"), "node"))

    def blocks(held: Column) -> Column:
        return F.ceil(F.greatest(F.count_if(held) / near.block, 8 * F.sum(F.when(held, F.col("n_shingles"))) / near.block_bytes))

    outside = F.col("outside")
    room = rows.join(classes.select("node", "n_shingles"), "node").groupBy("key").agg(blocks(outside).alias("others"), blocks(~outside).alias("mains"))
    rows = rows.join(signed, "node").join(room, "key")
    spread = F.xxhash64("node")
    own = F.when(outside, F.pmod(spread, "others")).otherwise(F.col("others") + F.pmod(spread, "mains"))
    upto = F.when(outside, F.col("others") + F.col("mains")).otherwise(F.col("others"))
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), upto - 1)))
    rows = rows.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    fields = ["key", "band", "i", "j", "own", "node", "root", "n_shingles", "codes", "signature", "hashes"]
    return stable(rows.select(*fields).groupBy("key", "i", "j").applyInPandas(across(near), PAIR).distinct())


def classes_of(signed: DataFrame) -> DataFrame:
    """A row per distinct set, stored."""
    return stable(
        signed.where("node is not null")
        .groupBy("node")
        .agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
    )


def near_report(docs: DataFrame, near: Near = Near()) -> DataFrame:  # noqa: B008
    """doc_id, text_key, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest id reachable over links; a text without words (NULL, empty) is alone. Rows
    that share an id are looked at one by one; NULL ids are never the smallest, a group of nothing else has a NULL
    component and its rows are kept. An empty table gives no rows; other columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {kind}, text_key bigint, n_shingles bigint, node binary, signature binary"
    signed = stable(docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(signer(near), fields))
    classes = classes_of(signed)
    held = buckets(classes, near)
    links = verify(prune(near_pairs(held, near), classes, near), classes, docs, near)
    groups = components(links)
    more = split_links(held, groups, classes, docs, near)
    if not more.isEmpty():
        groups = components(more.union(groups.where("node != root").toDF("a", "b")))
    rooted = classes.select("node", "first_id").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(least, "root").select(F.col("node").alias("known"), "component_id")
    rows = signed.select("doc_id", "text_key", "n_shingles", "node").join(named, F.col("node") == F.col("known"), "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    rows = rows.withColumn("component_id", component)
    return rows.select("doc_id", "text_key", "n_shingles", "component_id", same(F.col("doc_id"), F.col("component_id")).alias("kept"))


def deduplicated(docs: DataFrame, near: Near = Near()) -> DataFrame:  # noqa: B008
    """One document of each group, all columns; rows that repeat an id and text are one document.

    Of such rows the one with the least hash over all columns stays, so reruns agree. Texts without words (NULL,
    empty) stay, each alone; NULL ids are never the ones kept where a group has others. An empty table gives no rows.
    """
    report = stable(near_report(docs, near))
    gone = report.where("not kept").select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")).distinct()
    repeated = report.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").toDF("again_id", "again_key", "n")
    row = F.struct(*docs.columns).alias("whole_row")
    rows = docs.select(row, "doc_id", F.xxhash64("text").alias("text_key"))
    kept = rows.join(gone, same(F.col("doc_id"), F.col("gone_id")) & (F.col("text_key") == F.col("gone_key")), "left_anti")
    if not repeated.isEmpty():
        met = same(F.col("doc_id"), F.col("again_id")) & (F.col("text_key") == F.col("again_key"))
        several = kept.join(repeated, met, "left_semi").groupBy("doc_id", "text_key")
        one = several.agg(F.min_by("whole_row", F.md5(F.to_json("whole_row"))).alias("whole_row"))
        kept = kept.join(repeated, met, "left_anti").select("whole_row").union(one.select("whole_row"))
    return kept.select(*[F.col("whole_row")[c].alias(c) for c in docs.columns])
