"""Choosing, dropping, renaming and casting columns, and row filters on missing cells."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

KINDS = {"numeric": (T.NumericType,), "string": (T.StringType,)}


def col(name: str) -> Column:
    """Column by its exact name, also when the name holds dots or blanks."""
    return F.col("`" + name.replace("`", "``") + "`")


def select_groups(df: DataFrame, groups: Sequence[Sequence[str]]) -> DataFrame:
    """The columns of all groups in order; a column named by two groups is kept once."""
    return df.select(*(col(c) for c in dict.fromkeys(c for group in groups for c in group)))


def drop_identity(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the identity columns that are present."""
    return df.drop(*names)


def cols_of(df: DataFrame, kind: str) -> list[str]:
    """Names of the columns of any number type (``numeric``) or the text columns (``string``)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, KINDS[kind])]


def cols_like(df: DataFrame, pattern: str) -> list[str]:
    """Names that a regular expression finds (anywhere in the name)."""
    return [c for c in df.columns if re.search(pattern, c)]


def cols_between(df: DataFrame, start: int, stop: int | None = None) -> list[str]:
    """Names by position range."""
    return df.columns[start:stop]


def dedup_columns(df: DataFrame) -> DataFrame:
    """Keep the first of several columns with the same name."""
    seen: set[str] = set()
    keep = []
    for i, name in enumerate(df.columns):
        if name not in seen:
            keep.append(i)
        seen.add(name)
    if len(keep) == len(df.columns):
        return df
    unique = df.toDF(*(str(i) for i in range(len(df.columns))))
    return unique.select(*(F.col(str(i)).alias(df.columns[i]) for i in keep))


def null_columns(df: DataFrame) -> list[str]:
    """Columns with any missing cell, found in one aggregate pass."""
    row = df.agg(*(F.bool_or(col(c).isNull()).alias(str(i)) for i, c in enumerate(df.columns))).first()
    return [c for i, c in enumerate(df.columns) if row[i]]


def drop_null_columns(df: DataFrame) -> DataFrame:
    return df.drop(*null_columns(df))


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a missing cell in ``subset`` (default: in any column)."""
    return df.where(reduce(and_, (col(c).isNotNull() for c in subset or df.columns)))


def null_fraction(names: Sequence[str]) -> Column:
    return reduce(add, (col(c).isNull().cast("int") for c in names)) / F.lit(float(len(names)))


def filter_null_fraction(df: DataFrame, max_frac: float = 0.5) -> DataFrame:
    """Keep rows whose share of missing cells over all columns is below ``max_frac``."""
    return df.where(null_fraction(df.columns) < max_frac)


def lookup_company(df: DataFrame, **equal) -> DataFrame:
    """Rows equal in every named column; no row means the company is unknown."""
    return df.where(reduce(and_, (col(c) == v for c, v in equal.items())))


def find_by_name(df: DataFrame, names: Sequence[str] | DataFrame, column: str = "name") -> DataFrame:
    """All rows with one of the names: a literal list, or a one-column table of wanted names."""
    if isinstance(names, DataFrame):
        wanted = names.select(names[names.columns[0]].alias(column))
        return df.join(wanted, column, "left_semi")
    return df.where(col(column).isin(list(names)))


def null_pattern_counts(df: DataFrame, patterns: Mapping[str, Mapping[str, bool]]) -> DataFrame:
    """One count per pattern; a pattern says for each column whether it must be missing."""

    def matches(pattern: Mapping[str, bool]) -> Column:
        return reduce(and_, (col(c).isNull() if missing else col(c).isNotNull() for c, missing in pattern.items()))

    return df.agg(*(F.count_if(matches(p)).alias(name) for name, p in patterns.items()))


def any_null(names: Sequence[str]) -> Column:
    return reduce(or_, (col(c).isNull() for c in names))


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns; text that is no value of the type becomes NULL."""

    def cast(name: str, to: str) -> Column:
        c = col(name)
        return c.try_cast(to) if isinstance(df.schema[name].dataType, T.StringType) else c.cast(to)

    return df.withColumns({c: cast(c, to) for c, to in types.items()})
