"""Two fiscal years into one row per company."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from firmlens.functions.columns import col


def _fuse(df, key, year, later, earlier, keep_cols, merge: Callable[[Column, Column], Column]) -> DataFrame:
    kept, fused = [], []
    for f in df.schema.fields:
        if f.name in (key, year):
            continue
        numeric = isinstance(f.dataType, T.NumericType) and f.name not in keep_cols
        (fused if numeric else kept).append(f.name)

    # A key/year is one row; max ignores the NULLs of the other year. Aggregation starts on the
    # map side and the only shuffle is on the key.
    def of(y: int, c: str) -> Column:
        return F.max(F.when(col(year) == y, col(c)))

    both = df.where(col(year).isin(later, earlier)).groupBy(key).agg(
        F.bool_or(col(year) == later).alias("__has_later"),
        F.bool_or(col(year) == earlier).alias("__has_earlier"),
        *(of(later, c).alias(f"{c}__later") for c in kept + fused),
        *(of(earlier, c).alias(f"{c}__earlier") for c in fused),
    )

    def result(c: str) -> Column:
        late = col(f"{c}__later")
        if c in kept:
            return late.alias(c)
        early = col(f"{c}__earlier")
        return F.when(early == 0, F.lit(0.0)).otherwise(merge(late, early)).alias(c)

    rows = both.where(F.col("__has_later") & F.col("__has_earlier"))
    return rows.select(key, *(result(c) for c in df.columns if c not in (key, year)))


def fuse_years_weighted(
    df: DataFrame, key: str, year: str, later: int, earlier: int, keep_cols: Sequence[str] = (), w: float = 0.75
) -> DataFrame:
    """``w * later + (1 - w) * earlier`` for numbers, 0 on a zero earlier value; text and
    ``keep_cols`` keep the later value; companies without both years are dropped."""
    return _fuse(df, key, year, later, earlier, keep_cols, lambda a, b: a * w + b * (1 - w))


def fuse_years_pct(
    df: DataFrame, key: str, year: str, later: int, earlier: int, keep_cols: Sequence[str] = ()
) -> DataFrame:
    """Percent change from the earlier to the later year, with the same rules."""
    return _fuse(df, key, year, later, earlier, keep_cols, lambda a, b: F.try_divide(a - b, b) * 100)
