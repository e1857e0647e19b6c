"""Sentinels, accounting identities, dates and simple fills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from firmlens.functions.columns import col, cols_of

# The marker for "not stated", the date given to companies without a funding date,
# the round given to them, and the head-count where nothing is known.
NOT_STATED = "n.s."
NO_FUNDING_DATE = "1900-01-01"
NO_ROUND = "sin ronda"
DEFAULT_EMPLOYEES = 30


def null_sentinel(
    df: DataFrame, value: str = NOT_STATED, cast: str | None = "double", names: Sequence[str] | None = None
) -> DataFrame:
    """Replace the sentinel by NULL in text columns and make the columns numeric."""

    def clean(c: Column) -> Column:
        c = F.when(c != value, c)
        return c if cast is None else c.try_cast(cast)

    return df.withColumns({c: clean(col(c)) for c in (cols_of(df, "string") if names is None else names)})


def impute_balance(df: DataFrame) -> DataFrame:
    """Fill balance parts from the accounting identities, each fill seeing the one before."""
    total, fixed, current = F.col("total_assets"), F.col("fixed_assets"), F.col("current_assets")
    fixed = F.coalesce(fixed, total - current)
    current = F.coalesce(current, total - fixed)
    owed = F.col("total_liab_equity") - F.col("equity")
    noncurrent, short = F.col("noncurrent_liab"), F.col("current_liab")
    noncurrent = F.coalesce(noncurrent, owed - short)
    short = F.coalesce(short, owed - noncurrent)
    return df.withColumns(
        {
            "fixed_assets": fixed,
            "current_assets": current,
            "noncurrent_liab": F.coalesce(noncurrent, F.lit(0.0)),
            "current_liab": F.coalesce(short, F.lit(0.0)),
        }
    )


def recompute_totals(df: DataFrame) -> DataFrame:
    """Totals from their parts; a missing part makes the total missing."""
    return df.withColumns(
        {
            "total_assets": F.col("fixed_assets") + F.col("current_assets"),
            "equity": F.col("subscribed") + F.col("other_equity"),
            "working_capital": F.col("current_assets") - F.col("current_liab"),
        }
    )


def parse_funding_date(c: Column) -> Column:
    """``mon/yyyy`` or ``yyyy`` text to a timestamp; missing text is 1900-01-01.

    Text in neither form gives NULL.
    """
    parsed = F.coalesce(F.try_to_timestamp(c, F.lit("MMM/yyyy")), F.try_to_timestamp(c, F.lit("yyyy")))
    return F.when(c.isNull(), F.lit(NO_FUNDING_DATE).cast("timestamp")).otherwise(parsed)


def parse_slash_date(c: Column) -> Column:
    """``yyyy/MM/dd`` text to a timestamp."""
    return F.try_to_timestamp(c, F.lit("yyyy/MM/dd"))


def fill_where(df: DataFrame, name: str, value, cond: Column) -> DataFrame:
    """Fill missing cells of a column where a condition holds."""
    return df.withColumn(name, F.when(cond & col(name).isNull(), F.lit(value)).otherwise(col(name)))


def fill_funding(df: DataFrame, first_date: str = "first_funding_date") -> DataFrame:
    """The two rules for companies that never had a funding round."""
    never = col(first_date) == F.lit(NO_FUNDING_DATE).cast("timestamp")
    df = fill_where(df, "last_round", NO_ROUND, never)
    return fill_where(df, "last_funding", 0.0, col("total_funding") == 0)


def impute_group_mean(
    df: DataFrame, by: str, name: str, default: float = DEFAULT_EMPLOYEES, keep_null_group: bool = True
) -> DataFrame:
    """Fill with the group's mean, then with a constant.

    Rows without a group get no group mean. ``keep_null_group=False`` also discards their known
    values. Means come from a grouped aggregate (map-side combine) joined back, not from a window,
    so a group with a third of all rows is never gathered in one task.
    """
    means = df.where(col(by).isNotNull()).groupBy(by).agg(F.avg(col(name)).alias("__mean"))
    joined = df.join(means, by, "left")
    known = col(name) if keep_null_group else F.when(col(by).isNotNull(), col(name))
    filled = F.coalesce(known, F.col("__mean"), F.lit(float(default)))
    return joined.select(*(filled.alias(c) if c == name else col(c) for c in df.columns))
