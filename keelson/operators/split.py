"""Exact, reproducible splits and samples of entities.

Keys are ordered by the MD5 of ``seed:key``. The hash at the wanted position becomes a threshold, so membership is a
comparison on the key: it needs no join, no sort of all keys, and does not depend on partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions.digest import fingerprint, row_digest
from keelson.functions.scalar import stable_hash
from keelson.operators.compare import coverage, validated_left_join
from keelson.operators.ranks import hash_threshold, value_at_rank
from keelson.spec import ContractError, require_columns

TRAIN, TEST = "train", "test"


@dataclass(frozen=True)
class EntitySplit:
    """A decided split: everything needed to tell a key's side."""

    key: str
    seed: int
    fraction: float
    shuffle: bool
    entities: int
    test_entities: int
    threshold: object

    def side(self, key: Column | None = None) -> Column:
        """'train' or 'test' for a key column, as a plain expression."""
        k = F.col(self.key) if key is None else key
        if self.shuffle:
            test = stable_hash(k, self.seed) <= F.lit(self.threshold)
        else:
            test = k >= F.lit(self.threshold)
        return F.when(test, F.lit(TEST)).when(k.isNotNull(), F.lit(TRAIN))

    def assign(self, df: DataFrame, column: str = "split") -> DataFrame:
        return df.withColumn(column, self.side())


def split_entities(df: DataFrame, key: str, fraction: float, seed: int = 42, shuffle: bool = True) -> tuple[EntitySplit, DataFrame]:
    """(split, membership (key, split)) with exactly ceil(n * fraction) test keys of n distinct keys.

    Without ``shuffle`` the last keys in key order are the test side.
    """
    if not 0.0 < fraction < 1.0:
        raise ContractError("the test fraction must be between 0 and 1")
    require_columns(df, [key], "population")
    keys = df.where(F.col(key).isNotNull()).select(key).distinct()

    def test_size(n: int) -> int:
        if n - math.ceil(n * fraction) < 1:
            raise ContractError(f"{n} keys leave no training keys")
        return math.ceil(n * fraction)

    if shuffle:
        threshold, n = hash_threshold(keys.select(stable_hash(F.col(key), seed).alias("_h")), "_h", test_size)
        size = test_size(n)
    else:
        if not isinstance(df.schema[key].dataType, (T.LongType, T.IntegerType)):
            raise ContractError("a split in key order needs an integer key")
        n = keys.count()
        size = test_size(n)
        threshold = value_at_rank(keys.select(F.col(key).cast("bigint").alias("value")), "value", n - size, n)
    split = EntitySplit(key, seed, float(fraction), shuffle, n, size, threshold)
    return split, split.assign(keys)


def split_summary(split: EntitySplit, membership: DataFrame) -> DataFrame:
    """One row with sizes, fraction and fingerprint of the membership."""
    marks = fingerprint(membership.select(split.key, "split"))
    return marks.select(
        F.lit(split.seed).alias("seed"), F.lit(split.fraction).alias("fraction_requested"),
        F.lit(split.shuffle).alias("shuffle"), F.lit(split.entities).cast("bigint").alias("total_entities"),
        F.lit(split.entities - split.test_entities).cast("bigint").alias("train_entities"),
        F.lit(split.test_entities).cast("bigint").alias("test_entities"),
        F.lit(round(split.test_entities / split.entities, 6)).alias("actual_test_fraction"),
        F.col("data_fingerprint").alias("split_fingerprint"))


def require_split(population: DataFrame, membership: DataFrame, key: str) -> None:
    """Fail unless the membership covers the population exactly once with allowed values."""
    state = coverage(population, membership, key).first().asDict()
    broken = {k: v for k, v in state.items() if v}
    if broken:
        raise ContractError(f"split membership is invalid: {broken}")


def apply_split(df: DataFrame, membership: DataFrame, key: str, check: bool = True) -> DataFrame:
    """Attach a stored membership table; keys must be unique on both sides, and every row must be assigned."""
    joined = validated_left_join(df, membership.select(key, "split"), key, check)
    if check:
        require_domain(membership, "split", (TRAIN, TEST))
    return joined


def require_domain(df: DataFrame, column: str, allowed: Sequence[str]) -> None:
    bad = df.where(F.col(column).isNull() | ~F.col(column).isin(list(allowed))).select(column).limit(1).collect()
    if bad:
        raise ContractError(f"unexpected value in {column}: {bad[0][0]}")


def split_frames(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train rows, test rows); both must exist."""
    parts = tuple(df.where(F.col("split") == s) for s in (TRAIN, TEST))
    empty = [s for s, p in zip((TRAIN, TEST), parts) if p.isEmpty()]
    if empty:
        raise ContractError(f"no rows in {empty}")
    return parts


def exact_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows, the same ones under any partitioning; a NULL key is a key like others.

    Rows of the key at the threshold are taken by the order of their content, so repeated keys do not change the number.
    """
    hashed = df.withColumn("_h", F.coalesce(stable_hash(F.col(key), seed), F.md5(F.lit(f"{seed}:NULL key").cast("binary"))))
    threshold, total = hash_threshold(hashed.select("_h"), "_h", n)
    if threshold is None:
        return df.limit(0)
    sure = hashed.where(F.col("_h") < F.lit(threshold))
    left = min(n, total) - sure.count()
    last = hashed.where(F.col("_h") == F.lit(threshold)).withColumn("_d", row_digest(df)).orderBy("_d").limit(left).drop("_d")
    return sure.unionByName(last).drop("_h")


def sample_split(df: DataFrame, key: str, max_train: int, max_test: int, seed: int = 42) -> DataFrame:
    """Exact samples of the train and the test rows of a table with a ``split`` column."""
    parts = [exact_sample(df.where(F.col("split") == s), key, n, seed) for s, n in ((TRAIN, max_train), (TEST, max_test))]
    return parts[0].unionByName(parts[1])
