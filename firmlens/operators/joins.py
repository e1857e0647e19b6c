"""Joins of the registry, statement and funding tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from firmlens.functions.columns import col


def join_statements(
    a: DataFrame, b: DataFrame, keys: Sequence[str] = ("company_id", "year"), suffixes: tuple[str, str] = ("_x", "_y")
) -> DataFrame:
    """Full outer join on the composite key; equal names outside the key get suffixes."""
    shared = [c for c in a.columns if c in b.columns and c not in keys]
    a = a.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    b = b.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    return a.join(b, list(keys), "full_outer")


def join_company(legal: DataFrame, funding: DataFrame, facts: DataFrame, key: str = "company_id") -> DataFrame:
    """Legal and funding tables one to one, then all yearly facts, nothing lost on any side.

    The second full outer join is written as its two parts, facts with their company and companies
    without facts: a company with a great share of the facts can then be split over several tasks
    (adaptive skew join), which Spark cannot do for a full outer join. Both parts read all inputs,
    so settle an input that is expensive to compute.
    """
    firms = join_statements(legal, funding, [key])
    shared = [c for c in firms.columns if c in facts.columns and c != key]
    firms = firms.withColumnsRenamed({c: f"{c}_x" for c in shared})
    facts = facts.withColumnsRenamed({c: f"{c}_y" for c in shared})
    with_facts = facts.join(firms, key, "left").select(*firms.columns, *(c for c in facts.columns if c != key))
    without = firms.join(facts.select(key).distinct(), key, "left_anti")
    return with_facts.unionByName(without, allowMissingColumns=True)


def attach_by_key(df: DataFrame, other: DataFrame, key: str | Sequence[str], names: Sequence[str]) -> DataFrame:
    """Add columns of ``other`` to the rows of ``df`` with the same key."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.join(other.select(*keys, *(col(c) for c in names)), keys, "left")
