"""Train/test splits and folds that depend on the key only, not on partitioning or order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from firmlens.operators.ranking import rank_by_hash, uniform_hash

SEED = 42


def split_bucket(key: Column, seed: int = SEED) -> Column:
    """0..99 from the leading 32 bits of the hash of seed and key."""
    return F.conv(F.substring(uniform_hash(key, seed), 1, 8), 16, 10).cast("long") % 100


def split(df: DataFrame, key: str, test_frac: float, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Train and test rows."""
    is_test = split_bucket(F.col(key), seed) < round(100 * test_frac)
    return df.where(~is_test), df.where(is_test)


def stratified_folds(
    df: DataFrame, label: str, key: str, k: int = 5, repeats: int = 1, seed: int = SEED, name: str = "fold"
) -> DataFrame:
    """A fold number per row (and per repeat), dealt out evenly inside each label."""
    rows = df if repeats == 1 else df.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    salt = [F.col(key)] if repeats == 1 else [F.col("repeat"), F.col(key)]
    group = [label] if repeats == 1 else [label, "repeat"]
    ranked = rank_by_hash(rows.withColumn("__digest", uniform_hash(salt, seed)), group, "__digest", "__rank")
    return ranked.select(*rows.columns, (F.col("__rank") % k).cast("int").alias(name))
