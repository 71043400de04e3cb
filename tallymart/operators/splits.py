"""Train/test splits and folds decided by a hash of the key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions.defaults import FOLDS, SEED, TEST_SHARE, TRAIN_SHARE
from tallymart.functions.hashing import in_share, key_hash
from tallymart.operators.ranks import hash_cutoffs, row_numbers
from tallymart.session import stable


def hash_split(df: DataFrame, key: str, train_share: float = TRAIN_SHARE, seed: int = SEED) -> DataFrame:
    """Add ``split``: "train" for about ``train_share`` of the keys, else "test". No shuffle."""
    train = in_share(key_hash(key, seed), train_share)
    return df.withColumn("split", F.when(train, "train").otherwise("test"))


def _passed_quotas(df: DataFrame, key: str, label: str, seed: int, quotas: dict[str, Column]) -> DataFrame:
    """Add ``_passed``: of how many quotas of its class a row lies beyond, in the order of the key's hash.

    Rows of one key share a hash. Where a quota ends between them, they are numbered and cut apart, by the hash of
    their other columns; the others need no numbers. Cutoffs come from a stored table of classes and hashes, so the
    input is read twice, and a third time only if a quota ends inside a key.
    """
    hashed = df.withColumn("_hash", key_hash(key, seed))
    narrow = stable(hashed.select(label, "_hash"))
    sizes = narrow.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    missing = sizes.where(F.col(label).isNull()).first()
    if missing:
        raise ValueError(f"{missing['_n']} rows have no {label}; drop them or label them")
    parts = [F.struct(F.lit(p).alias("part"), q.cast("bigint").alias("quota")) for p, q in quotas.items()]
    limits = stable(hash_cutoffs(narrow, label, "_hash", sizes.select(label, F.inline(F.array(*parts)))))
    listed = limits.groupBy(label).agg(F.collect_list(F.struct("cutoff", "allowed", "copies")).alias("_cutoffs"))
    rows = hashed.join(listed, label, "left").withColumn("_copy", F.lit(1).cast("bigint"))
    if not limits.where("allowed < copies").isEmpty():
        apart = F.coalesce(F.exists("_cutoffs", lambda c: (c["cutoff"] == F.col("_hash")) & (c["allowed"] < c["copies"])), F.lit(False))
        content = F.xxhash64(*df.columns).alias("_content")
        tied = rows.where(apart).drop("_copy").select("*", content)
        rows = rows.where(~apart).unionByName(row_numbers(tied, [label, "_hash"], ["_content"], "_copy").drop("_content"))
    first = lambda c: (F.col("_hash") < c["cutoff"]) | ((F.col("_hash") == c["cutoff"]) & (F.col("_copy") <= c["allowed"]))
    return rows.withColumn("_passed", len(quotas) - F.coalesce(F.size(F.filter("_cutoffs", first)), F.lit(0)))


def stratified_split(df: DataFrame, key: str, label: str, test_share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """Add ``split`` with exactly ``round(test_share * n)`` test rows in each class of n rows.

    Labels must be present. Rows that share a key lie on the same side, except those of the one key per class in
    which the quota ends. The cutoff hash of each class is joined; rows are not sorted.
    """
    rows = _passed_quotas(df, key, label, seed, {"test": F.round(F.col("_n") * F.lit(test_share))})
    split = F.when(F.col("_passed") == 0, "test").otherwise("train")
    return rows.withColumn("split", split).select(*df.columns, "split")


def stratified_folds(df: DataFrame, key: str, label: str, folds: int = FOLDS, seed: int = SEED) -> DataFrame:
    """Add ``fold`` in 0..folds-1; the folds of a class differ by at most one row. Keys may repeat, as in the split."""
    quotas = {f"{i}": F.floor(F.col("_n") * i / folds) for i in range(1, folds)}
    return _passed_quotas(df, key, label, seed, quotas).withColumn("fold", F.col("_passed")).select(*df.columns, "fold")
