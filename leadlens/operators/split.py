"""Train/test splits and cross-validation folds that do not depend on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import rank_rows


def hash_bucket(key: str | Column, modulo: int = 100, seed: int | str | None = None) -> Column:
    """Stable bucket in [0, modulo) from the first 32 bits of md5(seed:key). The same
    value is computed by DuckDB as ('0x' || substr(md5(..), 1, 8))::BIGINT % modulo."""
    k = F.col(key).cast("string") if isinstance(key, str) else key.cast("string")
    if seed is not None:
        k = F.concat(F.lit(f"{seed}:"), k)
    return F.pmod(F.conv(F.substring(F.md5(k), 1, 8), 16, 10).cast("bigint"), F.lit(modulo))


def hash_split(df: DataFrame, key: str = "key", train_pct: int = 80, seed: int | str | None = None,
               col: str = "is_train") -> DataFrame:
    """Flag ``col`` = True for about ``train_pct`` % of rows, decided by the key alone, so
    the split is identical on any cluster, partitioning or rerun."""
    return df.withColumn(col, hash_bucket(key, 100, seed) < F.lit(train_pct))


def train_test(df: DataFrame, key: str = "key", train_pct: int = 80, seed: int | str | None = None):
    flagged = hash_split(df, key, train_pct, seed, "_is_train")
    return flagged.where("_is_train").drop("_is_train"), flagged.where("NOT _is_train").drop("_is_train")


def hash_folds(df: DataFrame, key: str = "key", k: int = 5, seed: int | str | None = None, col: str = "fold") -> DataFrame:
    """Fold 1..k by key hash (the scalable choice: no ordering, no extra shuffle)."""
    return df.withColumn(col, (hash_bucket(key, k, seed) + 1).cast("int"))


def contiguous_folds(df: DataFrame, order: Sequence[str], k: int = 5, col: str = "fold") -> DataFrame:
    """Unshuffled k-fold: rows in ``order`` cut into k contiguous folds 1..k, the first
    n mod k folds one row larger (the ``ntile`` rule). Positions come from the
    range-partitioned ranking, not a one-task window."""
    ranked = rank_rows(df, order, rank_col="_r", size_col="_n")
    n, r = F.col("_n"), F.col("_r")
    q = F.floor(n / k)
    rem = n - q * k
    big = rem * (q + 1)
    fold = F.when(r < big, F.floor(r / (q + 1))).otherwise(rem + F.floor((r - big) / q)) + 1
    return ranked.withColumn(col, fold.cast("int")).drop("_r", "_n")
