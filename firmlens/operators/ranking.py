"""Exact ranks without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from firmlens.functions.columns import col
from firmlens.session import settle


def uniform_hash(key: Column | Sequence[Column], seed: int) -> Column:
    """32 hex digits, evenly spread, the same on every run and under every partitioning."""
    keys = [key] if isinstance(key, Column) else list(key)
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(k.cast("string") for k in keys)))


def rank_by_hash(df: DataFrame, group: Sequence[str], digest: str, name: str, digits: int = 3) -> DataFrame:
    """``row_number`` (from 0) of each row by ``digest`` within its group.

    The leading hex digits cut a group into equal buckets, so a group with a third of all rows is
    ranked in ``16 ** digits`` tasks: rank inside the bucket plus the sizes of the buckets before
    it. Bucket sizes are counted with map-side aggregation.
    """
    rows = df.withColumn("__bucket", F.substring(col(digest), 1, digits))
    sizes = rows.groupBy(*group, "__bucket").count()
    before = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *group, "__bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__offset")
    )
    inside = Window.partitionBy(*group, "__bucket").orderBy(digest)
    ranked = rows.withColumn("__inside", F.row_number().over(inside) - 1)
    same = [ranked[c].eqNullSafe(offsets[c]) for c in (*group, "__bucket")]
    return ranked.join(offsets, same, "inner").select(
        *(ranked[c] for c in df.columns), (F.col("__inside") + F.col("__offset")).alias(name)
    )


def rank_distinct(values: DataFrame, name: str, code: str) -> DataFrame:
    """Sorted position (from 0) of each value of a duplicate-free, NULL-free column.

    The values are range-partitioned and written once; a value's code is then its place in its
    range plus the sizes of the ranges before.
    """
    parts = values.repartitionByRange(F.col(name)).sortWithinPartitions(name)
    # The written copy pins the ranges, so that a re-run task cannot number them anew.
    placed = settle(parts.select(name, F.monotonically_increasing_id().alias("__id")))
    placed = placed.select(
        name,
        F.shiftright("__id", 33).alias("__range"),
        F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)).alias("__place"),
    )
    sizes = placed.groupBy("__range").count()
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__offset"))
    # One row per range partition: bounded by the shuffle partition count.
    return placed.join(F.broadcast(offsets), "__range").select(
        name, (F.col("__place") + F.col("__offset")).alias(code)
    )
