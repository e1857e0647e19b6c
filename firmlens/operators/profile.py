"""Counts, profiles, correlations, reconciliation checks, pivots and extremes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations
from operator import add

from pyspark.sql import Column, DataFrame, Window, functions as F

from firmlens.functions.columns import col, cols_of
from firmlens.operators.quantiles import quantiles_and
from firmlens.session import settle, temporary

CORR_BATCH = 500


def companies_by_place(
    df: DataFrame, rows_per_company: int = 2, place: str = "place", key: str = "company_id"
) -> DataFrame:
    """Companies by place: rows with a company id divided by the rows per company, truncated."""
    return df.where(col(place).isNotNull()).groupBy(place).agg(
        (F.count(key) / rows_per_company).cast("int").alias("companies")
    )


def distinct_companies_by_place(df: DataFrame, place: str = "place", key: str = "company_id") -> DataFrame:
    """The same figure without assuming two rows per company."""
    return df.where(col(place).isNotNull()).groupBy(place).agg(F.count_distinct(key).alias("companies"))


def value_counts(df: DataFrame, name: str, scale: int = 1, counted: str | None = None) -> DataFrame:
    """Rows (or non-missing cells of ``counted``) per value, times ``scale``; missing values dropped."""
    n = F.count(F.lit(1)) if counted is None else F.count(col(counted))
    return df.where(col(name).isNotNull()).groupBy(col(name)).agg((n * scale).alias("n"))


def null_profile(df: DataFrame) -> DataFrame:
    """Missing cells and their share per column, most first."""
    names = df.columns
    wide = df.agg(
        F.count(F.lit(1)).alias("__n"), *(F.count_if(col(c).isNull()).alias(f"__{i}") for i, c in enumerate(names))
    )
    entries = F.array(
        *(F.struct(F.lit(c).alias("variable"), F.col(f"__{i}").alias("missing")) for i, c in enumerate(names))
    )
    return (
        wide.select("__n", F.explode(entries).alias("e"))
        .select("e.variable", "e.missing", F.try_divide(F.col("e.missing"), F.col("__n")).alias("fraction"))
        .orderBy(F.desc("missing"), "variable")
    )


def total_missing(df: DataFrame) -> DataFrame:
    return df.agg(reduce(add, (F.count_if(col(c).isNull()) for c in df.columns)).alias("missing"))


def count_sentinel(df: DataFrame, value: str) -> DataFrame:
    """Cells of any text column that hold ``value``."""
    names = cols_of(df, "string")
    if not names:
        return df.agg(F.count_if(F.lit(False)).alias("cells"))
    return df.agg(reduce(add, (F.count_if(col(c) == value) for c in names)).alias("cells"))


def missing_min(df: DataFrame, name: str) -> DataFrame:
    """Rows with a missing cell, number of columns, smallest known value."""
    return df.agg(
        F.count_if(col(name).isNull()).alias("missing_rows"),
        F.max(F.lit(len(df.columns))).alias("n_columns"),
        F.min(col(name)).alias("min"),
    )


def describe(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std, min, quartiles and max of numeric columns, one row per column."""
    names = list(names or cols_of(df, "numeric"))
    stats = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    wanted = [
        fn(col(c)).cast("long" if s == "count" else "double").alias(f"{s}__{i}")
        for i, c in enumerate(names)
        for s, fn in stats.items()
    ]
    with temporary(df.sparkSession):
        quartiles, wide = quantiles_and(settle(df.select(*(col(c) for c in names))), names, [0.25, 0.5, 0.75], wanted)
    rows = [(c, *(wide[f"{s}__{i}"] for s in stats), *quartiles[c]) for i, c in enumerate(names)]
    schema = "variable string, count long, mean double, std double, min double, max double, q1 double, median double, q3 double"
    return df.sparkSession.createDataFrame(rows, schema)


def table_shape(df: DataFrame, key: str) -> DataFrame:
    """Rows, columns, distinct keys."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(F.lit(len(df.columns))).alias("columns"),
        F.count_distinct(key).alias("companies"),
    )


def _corr(a: str, b: str) -> Column:
    """Pearson correlation over rows that have both; no spread on a side gives NULL."""
    both = col(a).isNotNull() & col(b).isNotNull()
    x, y = F.when(both, col(a).cast("double")), F.when(both, col(b).cast("double"))
    flat = (F.min(x) == F.max(x)) | (F.min(y) == F.max(y))
    return F.when(~flat, F.corr(x, y))


def corr_matrix(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Pairwise-complete correlations as rows (a, b, corr), every ordered pair and the diagonal."""
    pairs = list(combinations(names, 2)) + [(c, c) for c in names]
    batches = [pairs[i : i + CORR_BATCH] for i in range(0, len(pairs), CORR_BATCH)]
    return reduce(DataFrame.unionByName, (_corr_batch(df, b) for b in batches))


def _corr_batch(df: DataFrame, pairs) -> DataFrame:
    wide = df.agg(*(_corr(a, b).alias(str(i)) for i, (a, b) in enumerate(pairs)))
    entries = []
    for i, (a, b) in enumerate(pairs):
        for left, right in {(a, b), (b, a)}:
            entries.append(F.struct(F.lit(left).alias("a"), F.lit(right).alias("b"), col(str(i)).alias("corr")))
    return wide.select(F.inline(F.array(*entries)))


def corr_with(df: DataFrame, target: str, names: Sequence[str] | None = None, top: int | None = None) -> DataFrame:
    """Signed correlation of each column with the target, highest first, the target itself left out."""
    names = [c for c in names or cols_of(df, "numeric") if c != target]
    batches = [names[i : i + CORR_BATCH] for i in range(0, len(names), CORR_BATCH)]
    parts = []
    for batch in batches:
        wide = df.agg(*(_corr(c, target).alias(str(i)) for i, c in enumerate(batch)))
        entries = [F.struct(F.lit(c).alias("variable"), col(str(i)).alias("corr")) for i, c in enumerate(batch)]
        parts.append(wide.select(F.inline(F.array(*entries))))
    out = reduce(DataFrame.unionByName, parts).orderBy(F.desc_nulls_last("corr"), "variable")
    return out if top is None else out.limit(top)


def reconcile(df: DataFrame, rules: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Per rule: rows where both sides agree, differ, or cannot be compared."""
    out = []
    for name, (left, right) in rules.items():
        agree = left == right
        out.append((name, [F.count_if(agree), F.count_if(~agree), F.count_if(agree.isNull())]))
    labels = ("agree", "differ", "unknown")
    wide = df.agg(*(c.alias(f"{name}__{lab}") for name, cs in out for c, lab in zip(cs, labels)))
    entries = [
        F.struct(F.lit(name).alias("rule"), *(col(f"{name}__{lab}").alias(lab) for lab in labels)) for name, _ in out
    ]
    return wide.select(F.inline(F.array(*entries)))


def first_violation(df: DataFrame, rule: tuple[Column, Column], order: Sequence[str]) -> DataFrame:
    """The first row (by ``order``) that breaks the rule."""
    return df.where(rule[0] != rule[1]).orderBy(*order).limit(1)


def group_mean(df: DataFrame, by: str, name: str) -> DataFrame:
    return df.where(col(by).isNotNull()).groupBy(by).agg(F.avg(col(name)).alias("mean"))


def filtered_agg(df: DataFrame, cond: Column, name: str) -> DataFrame:
    """Mean of a column and number of rows under a condition."""
    return df.agg(F.avg(F.when(cond, col(name))).alias("mean"), F.count_if(cond).alias("n"))


def pivot_year(df: DataFrame, key: str, year: str, value: str, years: Sequence[int]) -> DataFrame:
    """One row per key and one value column per year."""
    picked = [F.max(F.when(col(year) == y, col(value))).alias(f"{value}_{y}") for y in years]
    return df.groupBy(key).agg(*picked)


def extremes(df: DataFrame, names: Sequence[str], k: int = 6, show: Sequence[str] = ("name", "year"), key: str = "company_id") -> DataFrame:
    """Top and bottom ``k`` rows of each column, ties by key, with the columns to show.

    One scan; the rank filter is pushed below the shuffle (window group limit), so each task sends
    at most ``k`` rows per column and direction.
    """
    entries = F.array(
        *(
            F.struct(
                F.lit(c).alias("variable"),
                F.lit(side).alias("side"),
                col(c).cast("double").alias("value"),
                (col(c).cast("double") * sign).alias("__order"),
            )
            for c in names
            for side, sign in (("bottom", 1.0), ("top", -1.0))
        )
    )
    shown = list(dict.fromkeys([key, *show]))
    long = df.select(*shown, F.inline(entries)).where(F.col("value").isNotNull())
    order = Window.partitionBy("variable", "side").orderBy("__order", *shown)
    ranked = long.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.drop("__order")
