"""Connected components of a large undirected graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from firmlens.session import settle


def _signature(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _with_least(edges: DataFrame) -> DataFrame:
    """Each ``u`` with the least node among itself and its neighbours ``v``: a grouped minimum
    (combined before the shuffle) joined back, so the join may split a node with many edges."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return edges.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v); root is the least node that is reachable.

    Alternating stars: every node links its larger neighbours to the least node it sees, then its
    smaller ones, until the links form stars around the roots. The links are written to the shared
    folder after each round, so no lineage grows and a lost executor costs one round at most.
    Self links and repeated links are allowed; no edges give no rows.
    """
    pairs = settle(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    )
    before, now = None, _signature(pairs)
    while now != before and now[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _with_least(large)
        pairs = settle(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v")))
            .distinct()
        )
        before, now = now, _signature(pairs)
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
