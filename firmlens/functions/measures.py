"""Derived measures: ratios, ages, free cash flow and numeric transforms."""

from __future__ import annotations

import math

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from firmlens.functions.columns import col

# ratio -> (numerator, denominator) as SQL over the statement columns
RATIOS = {
    "ratio_debt_ebitda": ("debt", "ebitda"),
    "ratio_debt_assets": ("debt", "total_assets"),
    "ratio_debt_equity": ("debt", "equity"),
    "ratio_ebitda_assets": ("ebitda", "total_assets"),
    "ratio_ebitda_equity": ("ebitda", "equity"),
    "ratio_sales_ebitda": ("sales", "ebitda"),
    "ratio_sales_assets": ("sales", "total_assets"),
    "ratio_sales_equity": ("sales", "equity"),
    "ratio_acid_test": ("current_assets - inventory", "current_liab"),
    "ratio_collection_days": ("payables * 365", "sales"),
}

LARGEST = 1.7976931348623157e308


def add_ratios(df: DataFrame, names: Sequence[str] = tuple(RATIOS)) -> DataFrame:
    """Financial ratios; a zero denominator gives NULL."""
    return df.withColumns({n: F.try_divide(F.expr(RATIOS[n][0]), F.expr(RATIOS[n][1])) for n in names})


def whole_days(start: Column, end: Column) -> Column:
    """Whole elapsed days (23:00 to 01:00 of the next day is 0)."""
    return F.timestamp_diff("DAY", start, end).cast("int")


def add_ages(df: DataFrame, as_of: dt.datetime, ages: dict[str, str]) -> DataFrame:
    """Age columns ``{new column: date column}`` in whole days at ``as_of``."""
    # As text, so that the date is read in the session's time zone like the columns.
    now = F.lit(as_of.isoformat(" ")).cast("timestamp")
    return df.withColumns({new: whole_days(col(date), now) for new, date in ages.items()})


def year_values(df: DataFrame, key: str, year: str, slots: dict[str, tuple[int, Column]]) -> DataFrame:
    """One row per key with the value an expression has in a given year.

    A plain grouped maximum: partial aggregation runs before the shuffle, so a key with very many
    rows never lands in one task as rows.
    """
    return df.groupBy(key).agg(
        *(F.max(F.when(col(year) == y, expr)).alias(name) for name, (y, expr) in slots.items())
    )


def year_delta(
    df: DataFrame, deltas: dict[str, tuple[Column, Column]], key: str, year: str, later: int, earlier: int
) -> DataFrame:
    """``later expression - earlier expression`` per key, on every year row of the key."""
    slots = {}
    for name, (late, early) in deltas.items():
        slots[f"{name}__late"] = (later, late)
        slots[f"{name}__early"] = (earlier, early)
    both = year_values(df, key, year, slots)
    diff = both.select(key, *((F.col(f"{n}__late") - F.col(f"{n}__early")).alias(n) for n in deltas))
    return df.join(diff, key, "left")


def free_cash_flow(
    df: DataFrame, later: int = 2021, earlier: int = 2020, key: str = "company_id", year: str = "year"
) -> DataFrame:
    """Capital expenditure, change in current assets and free cash flow."""
    deltas = {
        "capex": (F.col("fixed_assets"), F.col("fixed_assets") - F.col("amort")),
        "current_change": (F.col("current_assets"), F.col("current_assets")),
    }
    out = year_delta(df, deltas, key, year, later, earlier)
    flow = F.col("ebit") - F.col("taxes") + F.col("amort") - F.col("capex") - F.col("current_change")
    return out.withColumn("free_cash_flow", flow)


def log1p(c: Column) -> Column:
    """``ln(x + 1)``; NULL from -1 downwards."""
    return F.when(c > -1, F.log1p(c))


def log1p_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({c: log1p(col(c)) for c in names})


def nan_to_num(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Missing becomes 0, the infinities become the largest doubles."""

    def finite(c: Column) -> Column:
        c = F.coalesce(F.nanvl(c.cast("double"), F.lit(0.0)), F.lit(0.0))
        return F.greatest(F.least(c, F.lit(LARGEST)), F.lit(-LARGEST))

    return df.withColumns({c: finite(col(c)) for c in names})


def exp_pred(c: Column) -> Column:
    return F.exp(c)


def boxcox(c: Column, lam: float) -> Column:
    """Box-Cox transform of a positive value; NULL otherwise."""
    body = F.ln(c) if lam == 0 else (F.pow(c, F.lit(float(lam))) - 1) / F.lit(float(lam))
    return F.when(c > 0, body)


def inv_boxcox(c: Column, lam: float) -> Column:
    """Inverse Box-Cox; NULL where ``lam * y + 1`` is negative (outside the transform's range)."""
    if lam == 0:
        return F.exp(c)
    base = c * F.lit(float(lam)) + 1
    usable = base > 0 if lam < 0 else base >= 0
    return F.when(usable, F.pow(base, F.lit(1.0 / lam)))


def boxcox_fit(
    df: DataFrame, name: str, low: float = -2.0, high: float = 2.0, steps: int = 11, rounds: int = 6
) -> float:
    """The exponent of highest likelihood. Each round scores a whole grid in one aggregate pass
    and narrows to the cells around the best point; while that is an end of the grid, the next grid
    reaches beyond it."""
    x = F.when(col(name) > 0, col(name).cast("double"))
    mean_log = df.agg(F.avg(F.ln(x))).first()[0]
    if mean_log is None:
        raise ValueError(f"{name} has no positive value")
    # Dividing by the geometric mean keeps powers near 1 and only shifts the likelihood.
    log_z = F.ln(x) - F.lit(mean_log)
    best, left = 0.0, rounds
    while left:
        grid = [low + (high - low) * i / (steps - 1) for i in range(steps)]
        scores = []
        for i, lam in enumerate(grid):
            y = log_z if abs(lam) < 1e-9 else F.exp(log_z * F.lit(lam)) / F.lit(lam)
            scores.append(F.var_pop(y).alias(str(i)))
        row = [v if v is not None and math.isfinite(v) else math.inf for v in df.agg(*scores).first()]
        # With a geometric mean of 1 the likelihood falls exactly as the variance grows.
        at = min(range(steps), key=lambda i: row[i])
        best, width = grid[at], high - low
        if at in (0, steps - 1) and left == rounds and width < 1000 and max(row) > min(row):
            low, high = best - width, best + width
        else:
            low, high, left = grid[max(at - 1, 0)], grid[min(at + 1, steps - 1)], left - 1
    return best


def round_even(c: Column, digits: int = 0) -> Column:
    """Round half to even."""
    return F.bround(c, digits)
